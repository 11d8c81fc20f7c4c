"""Toxicity by weak supervision.

Voters vote "toxic" or "clean" where they fire and abstain elsewhere. Some need no labels: a public lexicon of
insults in four languages (a voter for each word), patterns (insults with letters replaced by digits or drawn out,
insults addressed to "you"), and for "clean" courteous words and formal lines. Others are mined: words and word
beginnings that fire far more often in one class of the labelled training texts, in whatever language. A label,
where there is one, is one more voter, which may be wrong like any other.

A generative model of the votes is fitted by expectation-maximisation, with the class unknown. Given the class, a
voter's vote depends on at most one other voter's: the pairs that depend on each other most (a maximum spanning tree
over conditional mutual information, without the pairs that chance explains) are in the likelihood, so voters that
repeat each other are not counted twice. Posteriors are exact. They start from the plain majority of the votes and
are the soft labels on which a linear classifier over the voters is trained; that classifier scores every whole text.

Learning is bounded by one parameter: ``per_class`` labelled documents of each label, those with the smallest hashes
of their ids (whole texts of any length). All voters with significant evidence of their own are kept: texts in which
``COVER`` stronger voters fire do not speak for another, so that a group of copies supports a few voters and not all
of its words. The sample bounds their number. Counts are gathered on the executors. The driver holds the sample's votes (rows x
voters bytes) and a few matrices of voters x voters, no texts. Scoring reads each text once, without a shuffle.

Defined results. Null or empty text: scored as a text in which no voter fires. Texts of any length are scored whole.
Labels that are null, or not 0 or 1, are not learned from; a document with several labels gives a row for each. No
labels of both kinds: every score is 0. Repeated rows are scored alike. An empty table gives an empty result. The
output replaces a kept column of its name; other columns may have any names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import blocks, durable, fold, resident, ship, table

#: The bound of learning: labelled documents of each class.
PER_CLASS = 8000
#: Lengths of word beginnings that may become patterns; shortest word.
BEGINNINGS, SHORTEST = (3, 4, 5, 6, 7), 3
#: A small public lexicon of insults in English, German, French and Spanish.
LEXICON = (
    "idiot", "moron", "stupid", "scum", "loser", "trash", "pathetic", "worthless", "disgusting", "imbecile", "dumbass", "bastard", "asshole", "jerk", "filth", "vermin",
    "dummkopf", "idioten", "abschaum", "arschloch", "trottel", "versager", "depp", "drecksack", "widerlich", "wertlos",
    "imbécile", "crétin", "connard", "salaud", "ordure", "abruti", "débile", "raclure", "minable", "dégoûtant",
    "idiota", "estúpido", "imbécil", "basura", "cabrón", "escoria", "inútil", "asqueroso", "patético", "gilipollas",
)
#: Words of courtesy, which vote "clean".
COURTEOUS = ("please", "thanks", "thank", "kindly", "welcome", "bitte", "danke", "merci", "bonjour", "gracias", "favor")
ADDRESSED = re.compile(r"\b(?:you|your|du|dein|tu|ton|eres|tus?)\W+(?:\w+\W+){0,2}?(" + "|".join(LEXICON) + r")\b")
FORMAL = re.compile(r"\b(?:licensed under|copyright|all rights reserved|terms of use)\b")
SHOUTED = re.compile(r"!{3,}|\?!+\?")
#: A mined voter must fire more often in one class than chance lets it with probability exp(-SIGNIFICANT).
SIGNIFICANT = 7.0
#: Voters that may fire in a text before it stops to speak for further ones.
COVER = 3
THRESHOLD = 0.7
REMEMBERED = 300_000
WORD = re.compile(r"\w+")
TOXIC, CLEAN = 1, 2
_PLAIN = str.maketrans("0134578@$!", "oieastbasi")


def spelled(word: str) -> str:
    """A word with digits for letters and drawn-out letters undone."""
    return re.sub(r"(\w)\1{2,}", r"\1", word.translate(_PLAIN))


#: Voters over whole texts (in lower case), by name; the sign of their vote.
PATTERNS = {
    "<addressed>": (TOXIC, lambda text: ADDRESSED.search(text) is not None),
    "<shouted>": (TOXIC, lambda text: SHOUTED.search(text) is not None),
    "<formal>": (CLEAN, lambda text: FORMAL.search(text) is not None),
}


def features(word: str) -> list[str]:
    """A word, and its beginnings as patterns ``abc*`` (the word itself is a beginning too)."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def mine(sample: DataFrame, per_class: dict[int, int]) -> dict[str, int]:
    """Words and beginnings that tell one class of the sample's labels from the other, with their votes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(0), 4_000_000):
                seen: dict[str, list[int]] = {}
                for t, y in zip(block, batch.column(1).slice(start, len(block)).to_pylist()):
                    for f in {f for w in set(WORD.findall(t.lower())) if len(w) >= SHORTEST for f in features(w)}:
                        seen.setdefault(f, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["f", "pos", "neg"])

    counts = sample.select("t", "y").mapInArrow(count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, n = float(per_class[1]), float(per_class[0])

    def telling(mine_: str, other: str, own: float, rest: float):
        """Fires at least 9 times as often in its class, and more often than chance lets it (Chernoff's bound)."""
        fires = F.col("pos") + F.col("neg")
        share, chance = F.col(mine_) / fires, own / (own + rest)
        bound = F.col(mine_) * F.log(share / chance) + F.when(F.col(other) > 0, F.col(other) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
        return (F.col(mine_) / own >= 9 * (F.col(other) + 0.5) / rest) & (bound >= SIGNIFICANT)

    # a voter for "clean" must speak of many texts: its silence, too, is a vote
    clean = telling("neg", "pos", n, p) & (F.col("neg") >= 0.02 * n)
    found = counts.select("f", F.when(telling("pos", "neg", p, n), TOXIC).when(clean, CLEAN).alias("vote")).where("vote is not null").collect()
    return {r["f"]: r["vote"] for r in sorted(found, key=lambda r: (len(r["f"]), r["f"]))}


class Voters:
    """Which voters fire in a text. Voters are words, beginnings ``abc*``, spellings ``~abc`` and ``PATTERNS``."""

    def __init__(self, names: list[str]):
        self.number = {f: i for i, f in enumerate(names)}
        self.lengths = sorted({len(f) - 1 for f in names if f.endswith("*")})
        self.spelled = any(f.startswith("~") for f in names)
        self.patterns = [(self.number[f], fires) for f, (_, fires) in PATTERNS.items() if f in self.number]
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        if (got := self.known.get(word)) is None:
            number = self.number
            hits = [number[word]] if word in number else []
            for n in self.lengths:
                if len(word) >= n and (i := number.get(f"{word[:n]}*")) is not None:
                    hits.append(i)
            if self.spelled and (plain := spelled(word)) != word and (i := number.get(f"~{plain}")) is not None:
                hits.append(i)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = tuple(hits)
            if len(word) <= 64:
                self.known[word] = got
        return got

    def fired(self, text: str) -> list[int]:
        text = text.lower()
        out = {i for i, fires in self.patterns if fires(text)}
        for w in set(WORD.findall(text)):
            if got := self.of_word(w):
                out.update(got)
        return sorted(out)


def evidence(own: float, other: float, rows: float, other_rows: float) -> float:
    """Nats by which a voter fires in its class beyond chance (Chernoff's bound on the probability of as much)."""
    chance = rows / (rows + other_rows)
    share = own / max(own + other, 1)
    if share <= chance:
        return 0.0
    return own * np.log(share / chance) + (other * np.log((1 - share) / (1 - chance)) if other else 0.0)


def telling_voters(votes: np.ndarray, labels: np.ndarray, toxic: np.ndarray, fixed: int, cover: int = COVER) -> np.ndarray:
    """Positions of voters to keep: the first ``fixed``, and those with evidence of their own.

    Mined voters come in the order of their evidence; texts of its class in which ``cover`` voters kept before
    already fire do not speak for a voter. So a group of copies supports a few voters and not all of its words.
    """
    mine = [(-evidence(*(int(votes[labels == y, j].sum()) for y in ((1, 0) if toxic[j] else (0, 1))), *(int((labels == y).sum()) for y in ((1, 0) if toxic[j] else (0, 1)))), j) for j in range(fixed, votes.shape[1])]
    keep = list(range(fixed))
    covered = {side: votes[:, :fixed][:, toxic[:fixed] == side].sum(axis=1, dtype=np.int64) for side in (True, False)}
    for _, j in sorted(mine):
        side = bool(toxic[j])
        own = labels == int(side)
        open_ = own & (covered[side] < cover)
        if evidence(int(votes[open_, j].sum()), int(votes[~own, j].sum()), int(own.sum()), int((~own).sum())) >= SIGNIFICANT:
            keep.append(j)
            covered[side] += votes[:, j]
    return np.array(keep, np.int64)


def dependence(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Conditional mutual information (in nats, times the rows) of each two voters given the class."""
    n = x.shape[1]
    total = np.zeros((n, n))
    x = x.astype(np.float32)
    for w in (1 - q, q):
        on = w.sum()
        if on <= 0:
            continue
        both = ((x * w[:, None].astype(np.float32)).T @ x).astype(np.float64)
        fire = np.diag(both).copy()
        for a in (1, 0):
            for b in (1, 0):
                pair = both if a and b else fire[:, None] - both if a else fire[None, :] - both if b else on - fire[:, None] - fire[None, :] + both
                pair = np.maximum(pair, 0)
                alone = (fire if a else on - fire)[:, None] * (fire if b else on - fire)[None, :] / on
                with np.errstate(divide="ignore", invalid="ignore"):
                    total += np.where((pair > 1e-9) & (alone > 0), pair * np.log(pair / alone), 0)
    np.fill_diagonal(total, 0)
    return np.maximum(total, 0)


def tree_of(strength: np.ndarray, least: float = 8.0) -> np.ndarray:
    """Each voter's parent in the maximum spanning forest of edges above ``least`` nats; -1 for roots. Parents come first in ``order``."""
    n = len(strength)
    parent, best, link = np.full(n, -1), np.full(n, -1.0), np.full(n, -1)
    inside = np.zeros(n, bool)
    for _ in range(n):
        v = int(np.where(inside, -2.0, best).argmax())
        inside[v] = True
        if best[v] >= least:
            parent[v] = link[v]
        better = ~inside & (strength[v] > best)
        best[better], link[better] = strength[v][better], v
    return parent


@dataclass
class LabelModel:
    """Class balance; each voter's parent; P(fires | parent silent or firing, class); the label's accuracies."""

    balance: float
    parent: np.ndarray  # (voters), -1: none
    rates: np.ndarray  # (voters, 2: parent fires, 2: toxic)
    gold: np.ndarray  # P(label 1 | other, toxic)

    @classmethod
    def fit(cls, votes: np.ndarray, labels: np.ndarray, toxic: np.ndarray, rounds: int = 8) -> tuple[LabelModel, np.ndarray]:
        """``votes`` (rows, voters) 0/1, ``labels`` 1, 0 or -1 (none), ``toxic`` (voters): whether a voter votes toxic.

        Returns the model and the rows' posteriors of toxic.
        """
        up, down = votes @ toxic.astype(np.float64) + (labels == 1), votes @ (~toxic).astype(np.float64) + (labels == 0)
        q = np.where(up > down, 0.9, np.where(down > up, 0.1, 0.3))  # the majority's say
        model = None
        for r in range(rounds):
            model = cls.given(votes, labels, q, tree_of(dependence(votes, q)) if r in (0, rounds // 2) else model.parent)
            q = model.posterior(votes, labels)
        return model, q

    @classmethod
    def given(cls, votes: np.ndarray, labels: np.ndarray, q: np.ndarray, parent: np.ndarray) -> LabelModel:
        """The model that fits posteriors best, with pseudo-counts."""
        x = votes.astype(np.float64)
        above = np.where(parent >= 0, x[:, np.maximum(parent, 0)], 0)
        w = np.stack([1 - q, q])  # (class, rows)
        on = w.sum(axis=1)
        alone = ((w @ x + np.array([[0.05], [0.5]])) / (on[:, None] + 1.0)).T  # (voters, class)
        rates = np.empty((x.shape[1], 2, 2))
        for a in (0, 1):
            there = above == a
            fires = np.stack([(v[:, None] * there * x).sum(axis=0) for v in w], axis=1)
            rows = np.stack([(v[:, None] * there).sum(axis=0) for v in w], axis=1)
            rates[:, a] = (fires + 2.0 * alone) / (rows + 2.0)
        known = labels >= 0
        # the label's prior: right in 9 of 10 cases, worth a tenth of the rows
        worth = 0.1 * known.sum()
        gold = np.array([(w[0, known] @ (labels[known] == 1) + 0.1 * worth + 1) / (w[0, known].sum() + worth + 2), (w[1, known] @ (labels[known] == 1) + 0.9 * worth + 1) / (w[1, known].sum() + worth + 2)])
        return cls(float(min(max(on[1] / on.sum(), 1e-4), 0.9999)), parent, rates.clip(1e-6, 1 - 1e-6), gold)

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """P(toxic | votes), exactly."""
        fire, silent = np.log(self.rates[:, :, 1] / self.rates[:, :, 0]), np.log((1 - self.rates[:, :, 1]) / (1 - self.rates[:, :, 0]))
        table = np.stack([silent, fire], axis=2).reshape(-1, 4)  # by 2 x parent fires + fires
        voters = np.arange(votes.shape[1])
        score = np.full(len(votes), np.log(self.balance / (1 - self.balance)))
        for at in range(0, len(votes), 1024):
            x = votes[at : at + 1024].astype(np.int64)
            above = np.where(self.parent >= 0, x[:, np.maximum(self.parent, 0)], 0)
            score[at : at + 1024] += table[voters, 2 * above + x].sum(axis=1)
        if labels is not None:
            say = np.array([np.log((1 - self.gold[1]) / (1 - self.gold[0])), np.log(self.gold[1] / self.gold[0]), 0.0])  # 0, 1, none
            score = score + say[np.where(labels >= 0, labels, 2)]
        return 1 / (1 + np.exp(-score.clip(-500, 500)))


@dataclass
class Model:
    """The linear classifier: a weight for each voter, for any toxic vote at all and for how many, and a constant."""

    names: list[str]
    weights: np.ndarray
    label_model: LabelModel | None = None
    toxic: np.ndarray | None = None

    def start(self) -> Model:
        self.voters = Voters(self.names)
        return self

    def score(self, text: str | None) -> float:
        if not len(self.weights):
            return 0.0
        w, fired = self.weights, self.voters.fired(text or "")
        total = w[-1]
        if fired:
            bad = int(self.toxic[fired].sum())
            total += w[fired].sum() + (w[-3] if bad else 0.0) + w[-2] * np.log1p(bad)
        return float(1 / (1 + np.exp(-min(max(total, -500.0), 500.0))))


def inputs(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    bad = votes[:, toxic].sum(axis=1)
    return np.column_stack([votes, bad > 0, np.log1p(bad), np.ones(len(votes))]).astype(np.float64)


def logistic(x: np.ndarray, q: np.ndarray, ridge: float = 0.3, rounds: int = 12) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        bend = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(x.T @ (x * bend[:, None]) + np.diag(penalty), x.T @ (q - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, training: Column, *, text: str = "text", ident: str = "doc_id", label: str = "toxic", per_class: int = PER_CLASS, lexicon: tuple[str, ...] = LEXICON, seed: int = 9) -> Model:
    """Fit on labelled rows where ``training`` (an expression over the labels' columns) holds."""
    spark = docs.sparkSession
    ship(spark)
    usable = labels.where(training & F.col(label).isin(0, 1) & F.col(ident).isNotNull()).select(F.col(ident).alias("i"), F.col(label).cast("int").alias("y")).distinct()
    hashed = usable.withColumn("h", F.xxhash64(F.lit(seed), "i"))
    picked = [r for y in (0, 1) for r in hashed.where(F.col("y") == y).orderBy("h", "i").limit(per_class).collect()]
    if not any(r["y"] == 1 for r in picked) or not any(r["y"] == 0 for r in picked):
        return Model([], np.zeros(0))
    few = spark.createDataFrame([(r["i"], r["y"]) for r in picked], usable.schema)  # at most 2 x per_class rows
    sample = durable(docs.join(F.broadcast(few), F.col(ident) == F.col("i")).select(F.col("y"), F.coalesce(F.col(text), F.lit("")).alias("t")))
    counts = {0: 0, 1: 0} | {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts[0] or not counts[1]:
        return Model([], np.zeros(0))
    given = {w: TOXIC for w in lexicon} | {f"~{w}": TOXIC for w in lexicon} | {w: CLEAN for w in COURTEOUS} | {f: v for f, (v, _) in PATTERNS.items()}
    polarity = given | {f: v for f, v in mine(sample, counts).items() if f not in given}
    names = list(polarity)
    shared = spark.sparkContext.broadcast(names)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(shared.value)
        for batch in batches:
            rows = [voters.fired(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["y", "fired"])

    found = sample.select("y", "t").mapInArrow(vote, "y int, fired array<int>").toArrow()
    y = found.column("y").to_numpy()
    votes = np.zeros((len(y), len(names)), np.uint8)
    lists = found.column("fired").combine_chunks()
    votes[np.repeat(np.arange(len(y)), np.asarray(lists.value_lengths())), np.asarray(lists.flatten())] = 1
    toxic = np.array([polarity[f] == TOXIC for f in names])
    keep = telling_voters(votes, y, toxic, len(given))
    names, votes, toxic = [names[i] for i in keep], votes[:, keep], toxic[keep]
    order = np.lexsort([*votes.T[:: max(1, len(names) // 24)], votes.sum(axis=1), y])  # sums do not depend on the order in which rows came
    label_model, q = LabelModel.fit(votes[order], y[order].astype(np.int64), toxic)
    return Model(names, logistic(inputs(votes[order], toxic), q), label_model, toxic)


def _started(shared) -> Model:
    """The model of a broadcast, made ready once in a worker."""
    key, model = shared.value
    return resident(key, model.start)


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, output: str = "score") -> DataFrame:
    """Columns ``keep`` (default: all) and the score, replacing a column of that name."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, Model(model.names, model.weights, None, model.toxic)))
    keep = [c for c in (keep if keep is not None else docs.columns) if c != output]
    source = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].alias("body"))
    schema = ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "s double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _started(shared)
        for batch in batches:
            values = [model.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(values, pa.float64())], names=[*(f"k{i}" for i in range(len(keep))), "s"])

    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("s").alias(output))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    out = score(docs, model, keep=["doc_id"])
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
