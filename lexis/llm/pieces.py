"""SentencePiece BPE: texts to ids and back, without the library's encoder.

Encoding by a prefix table. For every prefix of a unit of text the table
holds the last token of the prefix's encoding, which is unique: the tokens
that end at a position are found by one run of an Aho-Corasick automaton over
all pieces, and the one is taken that is compatible with the last token of the
prefix before it. The ids are read off backwards from the end. The time is
linear in the text, whatever its length.

Two tokens are compatible if merging their joint text never crosses the
border between them. Both tokens are taken apart from their last merge to
their first, the later made of the two symbols at the border at a time; the
border is crossed if two symbols that met there make a piece that ranks before
the merges that took them away (``Tables.compatible``).

Units: no piece holds the space mark behind another character, so the words
of a text, each with one mark in front, are encoded by themselves; so are
characters that no piece holds (byte pieces). Longer runs of marks stand
apart, as pieces of marks alone tie in rank or rank before their own parts; a
run's tokens follow from its length by the merges themselves, after the word
behind it has taken its mark or left it. ``read_model`` refuses a model for
which this does not hold. Workers keep the ids of the latest words and tests
of token pairs, up to ``KEPT_WORDS`` and ``KEPT_PAIRS``; that changes the speed
only.

Defined cases: a null text is empty; an empty text has no ids, and no ids are
an empty text; repeated rows and null ids of documents are kept as they are;
ids outside the vocabulary raise; an empty table stays empty; only the columns
named in ``keep`` are returned.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from lexis.llm.common import text_slices

MARK = "▁"
#: Words kept with their ids by a worker, characters of a kept word, and pairs
#: of tokens kept with their test.
KEPT_WORDS = 400_000
KEPT_CHARS = 64
KEPT_PAIRS = 400_000
UNKNOWN_TEXT = " ⁇ "

# Values of a model's piece types, and of its BPE algorithm.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


def read_model(path: str) -> dict:
    """Pieces, ranks, merge trees and special ids of a model file; read on the
    driver, of fixed size by the vocabulary."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(data := f.read())
    norm = m.normalizer_spec
    if (m.trainer_spec.model_type != BPE or not m.trainer_spec.byte_fallback or norm.precompiled_charsmap
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or m.trainer_spec.treat_whitespace_as_suffix or m.denormalizer_spec.precompiled_charsmap):
        raise ValueError("needs a BPE model with byte pieces, a space in front and no other normalisation")
    kinds = [p.type for p in m.pieces]
    if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("the model has user-defined or unused pieces")
    texts = [p.piece for p in m.pieces]
    scores = sorted({p.score for p in m.pieces if p.type == NORMAL}, reverse=True)
    order = {s: k for k, s in enumerate(scores)}
    rank = {p.piece: order[p.score] for p in m.pieces if p.type == NORMAL and len(p.piece) > 1}
    chars = sorted({c for t, k in zip(texts, kinds) if k == NORMAL for c in t})
    trees: dict[str, tuple[str, str] | None] = {c: None for c in chars}
    for t in sorted(rank, key=len):
        made = merged(t, rank)
        if len(made) == 1 and t.strip(MARK):
            trees[t] = made[0][1]
    for t, parts in trees.items():
        if MARK in t[1:] or parts and any(p in rank and rank[p] >= rank[t] for p in parts):
            raise ValueError(f"piece {t!r} stands across words, or ranks before its parts")
    several = [r for t, r in rank.items() if t in trees]
    if len(set(several)) < len(several):
        raise ValueError("pieces of equal rank")
    if any(set(t) == {MARK} and r <= max(several) for t, r in rank.items() if t == MARK * 2):
        raise ValueError("runs of marks merge before words")
    return {"ids": {t: i for i, t in enumerate(texts) if kinds[i] == NORMAL}, "rank": rank, "trees": trees,
            "bytes": {int(t[3:5], 16): i for i, t in enumerate(texts) if kinds[i] == BYTE},
            "texts": texts, "kinds": kinds, "digest": sha256(data).hexdigest()}


def merged(text: str, rank: dict[str, int]) -> list[tuple[str, tuple[str, str] | None]]:
    """The symbols that merging leaves, best rank first and then leftmost,
    each with the two symbols it was made of."""
    n = len(text)
    symbols, parts, after, before = list(text), [None] * n, list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, str]] = []

    def meet(a: int, b: int) -> None:
        if a >= 0 and b < n and (r := rank.get(symbols[a] + symbols[b])) is not None:
            heapq.heappush(heap, (r, a, symbols[a] + symbols[b]))

    for i in range(n - 1):
        meet(i, i + 1)
    while heap:
        _, a, made = heapq.heappop(heap)
        b = after[a] if symbols[a] else n
        if b >= n or symbols[a] + symbols[b] != made:
            continue                                       # one of the two has gone
        parts[a], symbols[a], symbols[b] = (symbols[a], symbols[b]), made, ""
        after[a] = after[b]
        if after[b] < n:
            before[after[b]] = a
        meet(before[a], a)
        meet(a, after[a])
    return [(s, p) for s, p in zip(symbols, parts) if s]


class Tables:
    """A worker's automaton, merge trees and kept words."""

    def __init__(self, model: dict):
        self.rank, self.trees, self.ids = model["rank"], model["trees"], model["ids"]
        self.bytes = model["bytes"]
        self.made = {t: self.rank.get(t, -1) for t in self.trees}      # a character was never made
        self.automaton = ahocorasick.Automaton()
        for t in self.trees:
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.emitted = {t: np.array([self.ids[t]], "<i4").tobytes() if t in self.ids else self.spelt(t)
                        for t in self.trees}
        odd = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in self.trees and chr(c) != " ")
        self.units = re.compile(f"{MARK}*[^{MARK}{odd}]+|{MARK}+|[{odd}]" if odd else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def spelt(self, char: str) -> bytes:
        return np.array([self.bytes[b] for b in char.encode()], "<i4").tobytes()

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging a + b leaves a, b."""
        rank, trees, made = self.rank, self.trees, self.made
        left, right = len(rank), len(rank)                  # ranks of the merges that took the two away
        while True:
            across = rank.get(a + b)
            if across is not None and across < left and across <= right:
                return False
            at_a, at_b = made[a], made[b]
            if at_a > at_b:
                left, a = at_a, trees[a][1]
            elif at_b >= 0:
                right, b = at_b, trees[b][0]
            else:
                return True

    def word(self, text: str) -> list[str]:
        """Tokens of a unit with at most one mark, at its start; a character
        that no piece holds is a token of its own."""
        last: list[str | None] = [None] * (len(text) + 1)
        pairs = self.pairs
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        for end, t in self.automaton.iter(text):
            end += 1
            if last[end] is not None:
                continue
            at = end - len(t)
            prior = last[at]
            if at == 0 or prior is None:                   # None: a character that no piece holds
                last[end] = t
                continue
            ok = pairs.get((prior, t))
            if ok is None:
                ok = pairs[prior, t] = self.compatible(prior, t)
            if ok:
                last[end] = t
        out, at = [], len(text)
        while at:
            out.append(last[at] or text[at - 1])
            at -= len(out[-1])
        return out[::-1]

    def unit(self, text: str) -> bytes:
        """Ids of a unit, as little-endian 32-bit integers."""
        run = 0 if text[0] != MARK else 1 if text[1:2] != MARK else len(text) - len(text.lstrip(MARK))
        tokens = self.word(text[run - 1:] if run else text) if run < len(text) else []
        marks = run
        if run and tokens:
            if tokens[0] == MARK:
                tokens = tokens[1:]
            else:
                marks = run - 1
        if marks:
            tokens = [t for t, _ in merged(MARK * marks, self.rank)] + tokens
        emitted, ids = self.emitted, self.ids
        return b"".join([emitted[t] if t in emitted else
                         np.array([ids[t]], "<i4").tobytes() if t in ids else self.spelt(t) for t in tokens])

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        new, out = self.new, []
        for u in self.units.findall(MARK + text.replace(" ", MARK)):
            got = new.get(u)
            if got is None:
                got = self.old.get(u)
                if got is None:
                    got = self.unit(u)
                if len(u) <= KEPT_CHARS:
                    if len(new) >= KEPT_WORDS // 2:
                        self.old, self.new = new, {}
                        new = self.new
                    new[u] = got
            out.append(got)
        return b"".join(out)


#: The tables of the model that this worker used last, by the model's digest.
_LAST: dict[str, Tables] = {}


def _tables(digest: str, model) -> Tables:
    if digest not in _LAST:
        _LAST.clear()
        _LAST[digest] = Tables(model.value)
    return _LAST[digest]


def encode(docs: DataFrame, model: dict, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``ids`` (array of int) of every whole text."""
    shared, digest = docs.sparkSession.sparkContext.broadcast(model), model["digest"]
    cols = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("text__"))
    schema = cols.drop("text__").schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(digest, shared)
        for batch in batches:
            for part in text_slices(batch, "text__"):
                ids = [tables.text(t) for t in part.column(len(keep)).to_pylist()]
                ends = np.cumsum([0] + [len(i) // 4 for i in ids], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), flat)], names=[*keep, "ids"])

    return cols.mapInArrow(run, schema)


def _spelled_out(ids: list[int], texts: list[bytes], kinds: list[int]) -> str:
    """The text of any ids: byte pieces that make no character are each shown
    as U+FFFD, control ids vanish, the first piece loses its space."""
    out, raw, begun = [], b"", False
    for i in [*ids, None]:
        if i is not None and kinds[i] == BYTE:
            raw, begun = raw + texts[i], True
            continue
        at = 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        raw = b""
        if i is None or kinds[i] == CONTROL:
            continue
        piece = texts[i].decode()
        out.append(piece[1:] if not begun and kinds[i] == NORMAL and piece[0] == " " else piece)
        begun = True
    return "".join(out)


def decode(tokens: DataFrame, model: dict, ids: str = "ids", keep: Sequence[str] = ("doc_id",),
           out: str = "text") -> DataFrame:
    """``keep`` and the text of every row's ids."""
    shared = tokens.sparkSession.sparkContext.broadcast({k: model[k] for k in ("texts", "kinds")})
    cols = tokens.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias("ids__"))
    schema = cols.drop("ids__").schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = shared.value["kinds"]
        texts = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else UNKNOWN_TEXT.encode()
                 if k == UNKNOWN else t.replace(MARK, " ").encode() for t, k in zip(shared.value["texts"], kinds)]
        table = pa.array(texts, pa.binary())
        plain = np.array([k in (NORMAL, BYTE) for k in kinds])
        spaced = np.array([k == NORMAL and t[:1] == b" " for k, t in zip(kinds, texts)])
        for batch in batches:
            col = pc.fill_null(batch.column(len(keep)), [])
            starts, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
            got = None
            if plain[flat[starts[0]:starts[-1]]].all():
                pieces = pa.ListArray.from_arrays(col.offsets, table.take(col.values))
                try:
                    joined = pc.binary_join(pieces, b"").cast(pa.string())
                    first = np.zeros(len(col), dtype=bool)
                    some = starts[1:] > starts[:-1]
                    first[some] = spaced[flat[starts[:-1][some]]]
                    got = pc.if_else(pa.array(first), pc.utf8_slice_codeunits(joined, 1), joined)
                except pa.ArrowInvalid:
                    pass                                   # bytes that make no text
            if got is None:
                got = pa.array([_spelled_out(x, texts, kinds) for x in col.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], got], names=[*keep, out])

    return cols.mapInArrow(run, schema)
