"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability in a
language is the sum, over all ways to cut it into pieces, of the product of the pieces' probabilities; the
forward algorithm gives that sum in one pass. A text's score is the sum over its words (runs of letters, in
lower case); the language with the largest posterior wins. A letter that no piece holds counts as a
piece of its own, so every word has a probability.

Words of up to ``vector_letters`` letters are summed many at once, tilted by a constant for each letter so that no
sum leaves a double's range; longer ones, of any length, as logarithms. Both are exact: nothing is cut or floored.

Learning: expectation-maximisation over a bounded sample (``per_language`` documents of each language, those
with the smallest hashes of their id and text; whole texts and whole words). The sample's words are counted on the
executors; the driver holds the distinct words of the sample, which the bound limits, and runs forward-backward over
them. Prediction covers all rows and whole texts; a word that recurs is computed once per worker and block.

Defined results. Null text, or one without a letter: ``und`` with score 1. Documents with a null language are
predicted but not learned from. Repeated rows count once when learning, and are predicted alike. Ties between
languages go to the first in the alphabet. Nothing to learn from: every text with letters is ``und``, score 0. More
than ``MOST_LANGUAGES`` languages are an error. An empty table gives an empty result. ``lang_pred`` and ``score``
replace kept columns of these names; other columns may have any names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import blocks, fold, resident, ship, table

#: Documents of each language that a model learns from, and rounds of expectation-maximisation.
PER_LANGUAGE, ROUNDS = 300, 3
UNKNOWN = "und"
REMEMBERED = 300_000
#: Letters up to which words go through the pass over many words at once, if their probabilities allow it.
MATRIX = 64
#: Most languages that a model may have; more are an error, since they would be no languages.
MOST_LANGUAGES = 1000
#: The mark of a word's beginning in the vocabulary.
MARK = "▁"
WORD = re.compile(r"[^\W\d_]+")


def default_pieces(path: str | None = None) -> list[str]:
    """Pieces made of letters, in lower case, with the mark for a word's beginning."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return sorted(p for p in found if p.replace("▁", "", 1).isalpha() and "▁" not in p[1:])


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


class Pieces:
    """The vocabulary as an automaton: a state is the longest tail of the letters so far that begins a piece."""

    def __init__(self, names: list[str]):
        self.names = names
        alphabet = sorted({c for name in names for c in name})
        self.letters = np.array([ord(c) for c in alphabet], np.int64)
        number = {c: i for i, c in enumerate(alphabet)}
        span = len(alphabet) + 1
        child: dict[int, int] = {}
        own, depth, parent = [-1], [0], [(0, 0)]
        for i, name in enumerate(names):
            state = 0
            for c in name:
                key = state * span + number[c]
                if (after := child.get(key)) is None:
                    after = child[key] = len(own)
                    own.append(-1)
                    depth.append(depth[state] + 1)
                    parent.append((state, number[c]))
                state = after
            own[state] = i
        fall = [0] * len(own)
        ends: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            up, c = parent[state]
            if up:
                back = fall[up]
                while (found := child.get(back * span + c)) is None and back:
                    back = fall[back]
                fall[state] = found or 0
            ends[state] = (((depth[state], own[state]),) if own[state] >= 0 else ()) + ends[fall[state]]
        # a letter that is no piece by itself counts as one, whatever the letter: number ``lone``
        ends = [e if e and e[-1][0] == 1 else (*e, (1, self.lone)) for e in ends]
        self.ends = ends
        self.span, self.fall = span, np.array(fall, np.int64)
        order = sorted(child)
        self.keys, self.targets = np.array(order, np.int64), np.array([child[k] for k in order], np.int64)
        self.n_ends = np.array([len(e) for e in ends], np.int64)
        self.first_end = np.cumsum(self.n_ends) - self.n_ends
        self.end_length, self.end_piece = np.array([x for e in ends for x in e], np.int64).reshape(-1, 2).T
        self.lengths = np.array([*map(len, names), 1], np.int64)

    @property
    def lone(self) -> int:
        """The number that stands for any letter without a piece."""
        return len(self.names)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Letters (code points) by their number in the alphabet; -1 for those in no piece."""
        if not len(self.letters):
            return np.full(codes.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, at, -1)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one more letter (by number)."""
        state, out = state.copy(), np.zeros_like(state)
        todo = np.flatnonzero(letter >= 0)
        while len(todo):
            key = state[todo] * self.span + letter[todo]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[todo[hit]] = self.targets[at[hit]]
            todo = todo[~hit & (state[todo] != 0)]
            state[todo] = self.fall[state[todo]]
        return out

    def matches(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every piece in the word with its beginning mark, by end; unmatched letters alone too."""
        state, states = np.zeros(1, np.int64), []
        for c in self.numbers(np.array([ord(c) for c in MARK + word], np.int64)):
            state = self.step(state, np.array([c]))
            states.append(int(state[0]))
        found = [(e + 1 - length, e + 1, piece) for e, s in enumerate(states) for length, piece in self.ends[s]]
        return tuple(np.array(found, np.int64).reshape(-1, 3).T)


class Lattice:
    """The matches of many words, by end, for passes over all of them at once."""

    def __init__(self, pieces: Pieces, words: list[str]):
        self.pieces = pieces
        self.length = np.array([len(w) + 1 for w in words], np.int64)
        order = np.argsort(-self.length, kind="stable")  # words that have a letter at some depth come first
        width = int(self.length.max(initial=1))
        codes = np.array([MARK + words[i] for i in order], f"U{width}").view(np.uint32).reshape(len(words), width)
        state = np.zeros(len(words), np.int64)
        self.by_end = []
        for at in range(width):
            state = state[: int((self.length > at).sum())]
            state = pieces.step(state, pieces.numbers(codes[: len(state), at].astype(np.int64)))
            n = pieces.n_ends[state]
            first = np.cumsum(n) - n
            pick = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(pieces.first_end[state], n)
            self.by_end.append((order[: len(state)], first, np.repeat(order[: len(state)], n), at + 1 - pieces.end_length[pick], pieces.end_piece[pick]))

    def forward(self, theta: np.ndarray) -> np.ndarray:
        """alpha (words, positions, languages)."""
        alpha = np.zeros((len(self.length), len(self.by_end) + 1, theta.shape[1]))
        alpha[:, 0] = 1
        for end, (who, first, word, start, piece) in enumerate(self.by_end, 1):
            alpha[who, end] = np.add.reduceat(alpha[word, start] * theta[piece], first, axis=0)
        return alpha

    def tilted(self, theta: np.ndarray) -> tuple[np.ndarray, float]:
        """Probabilities times exp(tilt) for each letter of a piece: sums stay in range, ratios do not change."""
        tilt = tilt_of(theta)
        return theta * np.exp(tilt * self.pieces.lengths)[:, None], tilt

    def log_likelihood(self, theta: np.ndarray) -> np.ndarray:
        scaled, tilt = self.tilted(theta)
        return np.log(self.forward(scaled)[np.arange(len(self.length)), self.length]) - tilt * self.length[:, None]

    def expected(self, theta: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (pieces, languages), for words seen ``counts`` (words, languages) times."""
        theta, _ = self.tilted(theta)
        alpha = self.forward(theta)
        whole = np.arange(len(self.length)), self.length
        beta = np.zeros_like(alpha)
        beta[whole] = 1
        share = counts / alpha[whole]
        out = np.zeros_like(theta)
        for end, (_, _, word, start, piece) in reversed(list(enumerate(self.by_end, 1))):
            through = beta[word, end] * theta[piece]
            np.add.at(beta, (word, start), through)
            np.add.at(out, piece, alpha[word, start] * through * share[word])
        return out


def tilt_of(theta: np.ndarray) -> float:
    """Half of the most that one letter can cost: so much is added for each letter to stay in a double's range."""
    return float(-np.log(theta.min(initial=1.0))) / 2


def vector_letters(theta: np.ndarray) -> int:
    """Letters up to which a word's tilted sums cannot leave a double's range; longer ones are summed as logarithms."""
    return int(min(MATRIX, 600 / max(tilt_of(theta), 1e-9))) - 1


def _log_sums(pieces: Pieces, word: str, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Logarithms of forward sums (positions, languages), of the probabilities, and the matches, for a word of any length."""
    logs, found = np.log(theta), pieces.matches(word)
    start, end, piece = found
    edges = np.searchsorted(end, np.arange(1, len(word) + 3))
    alpha = np.zeros((len(word) + 2, theta.shape[1]))
    for e in range(1, len(word) + 2):
        part = slice(edges[e - 1], edges[e])
        terms = alpha[start[part]] + logs[piece[part]]
        top = terms.max(axis=0)
        alpha[e] = top + np.log(np.exp(terms - top).sum(axis=0))
    return alpha, logs, found


def long_log_likelihood(pieces: Pieces, word: str, theta: np.ndarray) -> np.ndarray:
    """Log likelihood of a word of any length."""
    return _log_sums(pieces, word, theta)[0][-1]


def long_expected(pieces: Pieces, word: str, theta: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``Lattice.expected`` of one word of any length, seen ``counts`` (languages) times."""
    alpha, logs, (start, end, piece) = _log_sums(pieces, word, theta)
    by = np.argsort(start, kind="stable")
    edges = np.searchsorted(start[by], np.arange(len(word) + 2))
    beta = np.zeros_like(alpha)
    for s in range(len(word), -1, -1):
        part = by[edges[s] : edges[s + 1]]
        terms = beta[end[part]] + logs[piece[part]]
        top = terms.max(axis=0)
        beta[s] = top + np.log(np.exp(terms - top).sum(axis=0))
    out = np.zeros_like(theta)
    np.add.at(out, piece, np.exp(alpha[start] + logs[piece] + beta[end] - alpha[-1]) * counts)
    return out


@dataclass
class Model:
    languages: list[str]
    theta: np.ndarray
    prior: np.ndarray
    names: list[str]

    def start(self) -> Model:
        self.pieces = Pieces(self.names)
        self.known: dict[str, int] = {}
        self.logs = np.zeros((0, len(self.languages)))
        self.short = vector_letters(self.theta)
        return self

    def _learn_words(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
            self.logs = self.logs[:0]
        new = sorted(words - self.known.keys())
        if not new:
            return
        plain = [letters(w) for w in new]
        out = np.zeros((len(new), len(self.languages)))
        if self.languages:
            short = [i for i, w in enumerate(plain) if 0 < len(w) <= self.short]
            short.sort(key=lambda i: len(plain[i]))
            for at in range(0, len(short), 8192):
                part = short[at : at + 8192]
                out[part] = Lattice(self.pieces, [plain[i] for i in part]).log_likelihood(self.theta)
            for i, w in enumerate(plain):
                if len(w) > self.short:
                    out[i] = long_log_likelihood(self.pieces, w, self.theta)
        base = len(self.logs)
        self.logs = np.concatenate([self.logs, out])
        self.known.update((w, base + i if p else -1) for i, (w, p) in enumerate(zip(new, plain)))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language and its posterior, for a block of texts."""
        words = [WORD.findall(t.lower()) for t in texts]
        distinct: set[str] = set()
        for w in words:
            distinct.update(w)
        self._learn_words(distinct)
        get = self.known.__getitem__
        out = []
        for found in words:
            spots = np.fromiter(map(get, found), np.int64, len(found))
            spots = spots[spots >= 0]
            if not len(spots):
                out.append((UNKNOWN, 1.0))
            elif not self.languages:
                out.append((UNKNOWN, 0.0))
            else:
                score = self.logs[spots].sum(axis=0) + self.prior
                best = int(score.argmax())
                out.append((self.languages[best], float(1 / np.exp(np.minimum(score - score[best], 0)).sum())))
        for w in distinct:
            if len(w) > self.short:
                del self.known[w]
        return out


def learn(docs: DataFrame, training: Column, pieces: list[str] | None = None, *, text: str = "text", lang: str = "lang", ident: str = "doc_id", per_language: int = PER_LANGUAGE, rounds: int = ROUNDS, seed: int = 3) -> Model:
    """Fit on the rows where ``training`` holds and the language is not null."""
    spark = docs.sparkSession
    ship(spark)
    names = pieces if pieces is not None else default_pieces()
    body = F.coalesce(F.col(text), F.lit(""))
    usable = docs.where(training & F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.xxhash64(F.lit(seed), F.col(ident), body).alias("h"), body.alias("t"))
    first = usable.select("l", "h").withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("r") <= per_language)
    border = {r["l"]: r["m"] for r in first.groupBy("l").agg(F.max("h").alias("m")).limit(MOST_LANGUAGES + 1).collect()}
    if len(border) > MOST_LANGUAGES:
        raise ValueError(f"the column {lang} has over {MOST_LANGUAGES} values")
    languages = sorted(border)
    if not languages:
        return Model([], np.zeros((len(names) + 1, 0)), np.zeros(0), names)
    borders = F.broadcast(spark.createDataFrame(sorted(border.items()), "b string, most long"))  # at most MOST_LANGUAGES rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(1)):
                seen: dict[tuple[str, str], int] = {}
                for name, t in zip(batch.column(0).slice(start, len(block)).to_pylist(), block):
                    for w in WORD.findall(t.lower()):
                        seen[name, w] = seen.get((name, w), 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(seen.values(), pa.int64())], names=["l", "w", "n"])

    sample = usable.join(borders, (F.col("l") == F.col("b")) & (F.col("h") <= F.col("most"))).dropDuplicates(["l", "h"]).select("l", "t")
    counted = sample.mapInArrow(count, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    words: dict[str, int] = {}
    rows = []
    for name, w, n in zip(counted["l"], counted["w"], counted["n"]):
        w = letters(w)
        if w:
            rows.append((words.setdefault(w, len(words)), languages.index(name), n))
    counts = np.zeros((len(words), len(languages)))
    for i, k, n in rows:
        counts[i, k] += n
    vocabulary = Pieces(names)
    theta = np.full((len(names) + 1, len(languages)), 1.0 / (len(names) + 1))
    most = sum(n * (len(w) + 1) for w, n in zip(words, counts.sum(axis=1))) + 0.01 * (len(names) + 1)  # pieces used, at most
    short = vector_letters(np.array([[0.01 / most]]))
    order = sorted((w for w in words if len(w) <= short), key=len)
    long = [w for w in words if len(w) > short]
    parts = [order[at : at + 8192] for at in range(0, len(order), 8192)]
    lattices = [(Lattice(vocabulary, part), counts[[words[w] for w in part]]) for part in parts]
    for _ in range(rounds):
        uses = sum((lat.expected(theta, c) for lat, c in lattices), np.zeros_like(theta)) + 0.01
        for w in long:
            uses += long_expected(vocabulary, w, theta, counts[words[w]])
        theta = uses / uses.sum(axis=0)
    return Model(languages, theta, np.zeros(len(languages)), names)


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all), and ``lang_pred`` string and ``score`` double, replacing any of that name."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model))
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score")]
    source = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].alias("body"))
    schema = ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _started(shared)
        for batch in batches:
            for start, block in blocks(batch.column(batch.num_columns - 1)):
                said = model.predict(block)
                part = batch.slice(start, len(block))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())], names=[*(f"k{i}" for i in range(len(keep))), "lang_pred", "score"])

    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def _started(shared) -> Model:
    """The model of a broadcast, made ready once in a worker."""
    key, model = shared.value
    return resident(key, model.start)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 4) == 2
    model = learn(docs, ~held)
    return predict(docs, model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")
