"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

A text is cut into words by the vocabulary's split pattern. The distinct words of a block of texts form a
trie; a depth-first walk gives each node the last token of the encoding of the bytes that lead to it, and the
node where that token begins. The encoding of a node is that of the earlier node plus one token, so a prefix
that many words share is encoded once.

Why one step back is enough: the encoding of bytes ``s[:i]`` ends in exactly one token ``t = s[j:i]`` such
that ``t`` may follow the last token of ``s[:j]``; two tokens may stand side by side if and only if no merge
across their border would have been taken before the merges that build them.

Defined results. Null text: encoded as the empty text (0 tokens). Strings of added tokens in a text
(``<|endoftext|>``) become those tokens, as the tokenizers library does by default. Texts and words of any length
are encoded whole, in memory linear in their length. Repeated rows give repeated result rows. Kept columns may have
any names, but an output replaces a kept column of its name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import blocks, resident, ship, table

#: Fixed value: the split pattern of byte-level BPE vocabularies of this family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words a worker remembers between blocks; beyond that it forgets all and starts again.
REMEMBERED = 300_000
#: Letters beyond which a word is not remembered, so that what is remembered stays small.
LONG = 64
NEVER = 1 << 40


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: itself if printable, else 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """Encoder and decoder over one vocabulary file's JSON text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters, model = _byte_letters(), spec["model"]
        to_bytes = lambda piece: bytes(letters[c] for c in piece)
        self.vocab = {to_bytes(k): v for k, v in model["vocab"].items()}
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        for content in self.added:
            self.vocab.pop(content.encode(), None)
        self.token_bytes = {v: k for k, v in self.vocab.items()} | {v: k.encode() for k, v in self.added.items()}
        #: rank of the merge of two ids; and for each id the pair and rank that build it
        self.merge_rank: dict[tuple[int, int], int] = {}
        built: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, c = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.merge_rank.setdefault((a, b), rank)
            built.setdefault(c, (a, b, rank))
        self.built = built
        self.id_bytes = {v: v.to_bytes(4, "little") for v in self.token_bytes}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        self._tails()
        self.split = regex.compile(SPLIT)
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.source = source
        self._library = None
        self.words: dict[str, bytes] = {}

    def _tails(self) -> None:
        """An automaton over the vocabulary: a state is the longest tail of the bytes so far that begins a token.

        ``ends`` lists the tokens that end at a state, longest first, as (length, id); ``step`` remembers the
        transitions that were asked for.
        """
        child: dict[int, int] = {}
        ends: list[tuple[tuple[int, int], ...]] = [()]
        own: list[int] = [-1]
        depth, parent = [0], [(0, 0)]
        for token, number in self.vocab.items():
            state = 0
            for byte in token:
                key = state << 8 | byte
                if (after := child.get(key)) is None:
                    after = child[key] = len(own)
                    own.append(-1)
                    ends.append(())
                    depth.append(depth[state] + 1)
                    parent.append((state, byte))
                state = after
            own[state] = number
        fall = [0] * len(own)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            up, byte = parent[state]
            if up:
                back = fall[up]
                while (found := child.get(back << 8 | byte)) is None and back:
                    back = fall[back]
                fall[state] = found or 0
            ends[state] = (((depth[state], own[state]),) if own[state] >= 0 else ()) + ends[fall[state]]
        self.child, self.fall, self.ends = child, fall, ends
        self.step = dict(child)

    def _next(self, state: int, byte: int) -> int:
        back = state
        while (found := self.child.get(back << 8 | byte)) is None and back:
            back = self.fall[back]
        if len(self.step) > 400_000:
            self.step = dict(self.child)
        self.step[state << 8 | byte] = found = found or 0
        return found

    def _edge(self, token: int, side: int, memo: dict) -> list[tuple[int, int]]:
        """The pieces at one border of a token while it is built, each with the rank of the merge that absorbs it."""
        if (found := memo.get(token)) is None:
            found, absorbed, piece = [], NEVER, token
            while True:
                found.append((piece, absorbed))
                if piece not in self.built:
                    break
                absorbed = self.built[piece][2]
                piece = self.built[piece][side]
            memo[token] = found
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``: no merge across the border comes first.

        A merge across the border happens if its rank is below that of the merge which absorbs the left piece,
        and not above that of the merge which absorbs the right piece (equal ranks go left to right).
        """
        key = a << 20 | b
        if (known := self._fits.get(key)) is None:
            known, ranks = True, self.merge_rank
            for x, x_gone in self._edge(a, 1, self._right):
                for y, y_gone in self._edge(b, 0, self._left):
                    rank = ranks.get((x, y))
                    if rank is not None and rank < x_gone and rank <= y_gone:
                        known = False
                        break
                if not known:
                    break
            if len(self._fits) > 600_000:
                self._fits.clear()
            self._fits[key] = known
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of each distinct word as little-endian 32-bit integers.

        Sorted words visit the trie depth first: the stacks hold the states of the nodes on the way to the
        present word, and what it shares with the word before stays. A node holds its last token and that
        token's length, so memory is linear in a word's length.
        """
        out, id_bytes, fits, known, ends = {}, self.id_bytes, self.fits, self._fits, self.ends
        last: list[int] = [-1]  # by depth: the last token
        sizes: list[int] = [0]  # by depth: its length
        states: list[int] = [0]  # by depth: the automaton's state
        before = b""
        for raw, word in sorted((w.encode(), w) for w in words):
            shared, most = 0, min(len(raw), len(before))
            if raw[:most] == before[:most]:
                shared = most
            else:
                while raw[shared] == before[shared]:
                    shared += 1
            del last[shared + 1 :], sizes[shared + 1 :], states[shared + 1 :]
            state, i, step = states[-1], len(states) - 1, self.step
            for byte in raw[shared:]:
                i += 1
                if (after := step.get(state << 8 | byte)) is None:
                    after = self._next(state, byte)
                    step = self.step
                state = after
                for length, token in ends[state]:
                    j = i - length
                    if j == 0 or (fits(last[j], token) if (ok := known.get(last[j] << 20 | token)) is None else ok):
                        last.append(token)
                        sizes.append(length)
                        states.append(state)
                        break
                else:
                    raise ValueError(f"no token ends at byte {i} of {raw!r}")
            path = []  # the word's tokens, walked back from its end
            while i:
                path.append(id_bytes[last[i]])
                i -= sizes[i]
            path.reverse()
            out[word] = b"".join(path)
            before = raw
        return out

    def _pieces(self, text: str) -> list[str]:
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self._split_by_library(text)  # Unicode versions differ on letters that one of them lacks
        return self.split.findall(text)

    def _split_by_library(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _parts(self, text: str) -> list[str | bytes]:
        """Words, and the ids of added tokens as bytes."""
        if self.split_added is None or not self.split_added.search(text):
            return self._pieces(text)
        parts: list[str | bytes] = []
        at = 0
        for m in self.split_added.finditer(text):
            parts += self._pieces(text[at : m.start()])
            parts.append(self.id_bytes[self.added[m[0]]])
            at = m.end()
        return parts + self._pieces(text[at:])

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the words that are new in this block go through one trie."""
        parts = [self._parts(t) for t in texts]
        plain = [all(type(x) is str for x in p) if self.split_added is not None and self.split_added.search(t) else True for p, t in zip(parts, texts)]
        distinct: set[str] = set()
        for p, ok in zip(parts, plain):
            distinct.update(p if ok else (x for x in p if type(x) is str))
        if len(self.words) + len(distinct) > REMEMBERED:
            self.words.clear()
        words = self.words
        new = self.encode_words(distinct - words.keys())
        words.update(new)
        get = words.__getitem__
        out = [b"".join(map(get, p)) if ok else b"".join(x if type(x) is bytes else get(x) for x in p) for p, ok in zip(parts, plain)]
        for word in new:
            if len(word) > LONG:
                del words[word]
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoder_of(shared) -> TrieBpe:
    """One encoder for each vocabulary and Python worker; it outlives a task."""
    source = shared.value
    return resident(("bpe", hash(source)), lambda: TrieBpe(source))


def vocabulary_text(path: str | None = None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str | None = None, *, keep: list[str] | None = None, text: str = "text", outputs: tuple[str, ...] = ("n_tokens", "token_ids")) -> DataFrame:
    """Encode the column ``text`` of every row.

    ``keep``: columns carried along (default: all others but ``text``). ``outputs``, any of: ``n_tokens`` long,
    ``token_ids`` binary (ids as little-endian unsigned 32-bit integers), ``ids_sha256``, ``decoded_sha256``
    (of the ids decoded again) and ``decoded`` string. An output replaces a kept column of the same name.
    No shuffle: each task works through its own texts in blocks of bounded size.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary_text(vocabulary))
    keep = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c not in outputs]
    kinds = {"n_tokens": "long", "token_ids": "binary", "ids_sha256": "string", "decoded_sha256": "string", "decoded": "string"}
    source = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].alias("body"))
    schema = ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), *(f"{o} {kinds[o]}" for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder_of(shared)
        for batch in batches:
            body = batch.column(batch.num_columns - 1)
            for start, block in blocks(body):
                encoded = bpe.encode_block(block)
                made: dict[str, list] = {o: [] for o in outputs}
                for ids in encoded:
                    plain = bpe.decode(ids) if "decoded" in made or "decoded_sha256" in made else ""
                    for o, values in made.items():
                        values.append(
                            len(ids) // 4 if o == "n_tokens" else ids if o == "token_ids" else hashlib.sha256(ids).hexdigest() if o == "ids_sha256" else plain if o == "decoded" else hashlib.sha256(plain.encode()).hexdigest()
                        )
                types = {"n_tokens": pa.int64(), "token_ids": pa.binary()}
                part = batch.slice(start, len(block))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *(pa.array(v, types.get(o, pa.string())) for o, v in made.items())], names=[*(f"k{i}" for i in range(len(keep))), *outputs])

    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *outputs)


def decode(encoded: DataFrame, vocabulary: str | None = None, ids: str = "token_ids", output: str = "decoded") -> DataFrame:
    """Add the decoded text of a column of ids (binary, as ``encode`` gives it); null ids give a null text."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary_text(vocabulary))
    schema = encoded.select(*[c for c in encoded.columns if c != output], F.lit("").alias(output)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder_of(shared)
        for batch in batches:
            plain = [None if x is None else bpe.decode(x) for x in batch.column(ids).to_pylist()]
            others = [c for c in batch.schema.names if c != output]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(plain, pa.string())], names=[*others, output])

    return encoded.mapInArrow(run, schema)


def op3_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), keep=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
