"""Alignment of two tokenizers' tokens over a corpus, each distinct text worked on once.

Texts are shuffled by their full text, so that copies become one row with a multiplicity. Tokenizer A (byte-level pairs) encodes
a blank and the text, tokenizer B (pieces with byte fallback) the text, which it begins with a blank itself. The byte offsets where
tokens of both end cut the text into groups; each A token of a group is linked with each of its B tokens. A pair of ids counts
in as many documents as hold it linked, so pair counts are weighted by multiplicity. A document's measures, which use the
counts of the whole corpus, are joined to ids by the digest of the text.

How it stays bounded. Distinct texts are worked on in chunks of ``CHUNK_CHARS``. Neither tokenizer has tokens that run over a blank between
two characters that are not white space, and both tokenise what lies between such blanks by itself (``cuts_at_blanks`` checks
the vocabulary); texts are therefore made of units, and a task aligns each unit once. A chunk asks for the count of
each of its distinct pairs once, with the copies of its texts that hold it summed up; a pair's count is joined to these requests,
not to texts, and the answers return to their chunk. No group holds more than one chunk; a frequent pair has one request per chunk, in a
join that Spark may split. The units of a chunk name their pairs by place among the chunk's; these lists, most of a chunk, are kept as packed
bytes, so that Spark moves about 1.4 MB a chunk and has no elements to copy. The highest count of each A id is broadcast: one row per id of the
vocabulary at most. Long texts are read in pieces. A stretch without such a blank is tokenised in one go, whatever its length.

Defined results: texts that are null, empty, or whose joined token bytes differ from the blank and the text have no tokens: all measures
0, digest ''. Repeated rows and null ids are documents of their own. An empty table gives an empty result. Columns other than id and
text play no part. The vocabulary files must be at the same path on all executors.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage

FOLDER = "/opt/tokenizers"
BYTES_FILE, PIECES_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_CHARS = 1 << 20
PIECE_CHARS = 1 << 20
KNOWN_UNITS = 120_000  # of a task; it forgets them all when they are more
BATCH_CHARS = 1 << 16  # of units that are tokenised together
KNOWN_CHARS = 1 << 24
SALTS = 62  # copies of one text are dealt over so many keys
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
BLANK = "▁"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The byte of every character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Units:
    """What the alignment of stretches of text gives; ``groups`` is None where tokens don't give the stretch back."""

    counts: np.ndarray  # (units, 4): tokens of A, tokens of B, groups, links
    groups: list[str | None]
    n_pairs: np.ndarray
    pairs: np.ndarray  # the distinct pairs of one unit after the other, as a * (size of B) + b
    times: np.ndarray


def _joined(parts: list[Units]) -> Units:
    if len(parts) == 1:
        return parts[0]
    cat = lambda name: np.concatenate([getattr(p, name) for p in parts])
    return Units(cat("counts"), [g for p in parts for g in p.groups], cat("n_pairs"), cat("pairs"), cat("times"))


NONE = Units(np.zeros((0, 4), np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
BAD = Units(np.zeros((1, 4), np.int64), [None], np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


class Aligner:
    """Both tokenizers with the bytes of their tokens, and the units aligned so far."""

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        symbols = byte_symbols()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        of = lambda t: bytes(symbols[c] for c in t) if all(c in symbols for c in t) else t.encode()
        self.a_bytes = [of(names.get(i, "")) for i in range(max(names) + 1)]
        self.size_b = self.b.get_piece_size()
        self.pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes)]
        # every id followed by a comma, or by what ends its list: a bar for A, a semicolon for B
        self.shown = [f"{i}{e}" for size, last in ((len(self.a_bytes), "|"), (self.size_b, ";")) for i in range(size) for e in (",", last)]
        self.cuts = self.cuts_at_blanks()
        self.known: dict[str, int] = {}
        self.units, self.chars = NONE, 0

    def cuts_at_blanks(self) -> bool:
        """Whether both tokenise what lies between two single blanks by itself."""
        inside = re.compile(f"[^{BLANK}]{BLANK}")
        return str(self.a.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in str(
            self.a.pre_tokenizer) and self.a.normalizer is None and not any(inside.search(p) for p in self.pieces) and self._plain_pieces()

    def _plain_pieces(self) -> bool:
        return all(self.b.encode(s) == self.b.encode("x") + self.b.encode(s[2:]) for s in ("x y", "x ﬁ é"))

    def align(self, units: list[str]) -> Units:
        """The units, which may be joined by blanks if they begin and end with characters that are not white space."""
        text = " ".join(units)
        a = np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        whole = b" " + text.encode()
        if any(b"".join(map(own.__getitem__, ids.tolist())) != whole for own, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return BAD if len(units) == 1 else _joined([self.align([u]) for u in units])
        to_a, to_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        ends = to_a[np.isin(to_a, to_b, assume_unique=True)]
        unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
        last = np.searchsorted(ends, unit_ends)  # the last group of each unit
        cut_a, cut_b = (np.searchsorted(x, ends, "right") for x in (to_a, to_b))  # tokens up to the end of each group
        first_a, first_b = (np.concatenate([[0], c[:-1]]) for c in (cut_a, cut_b))
        n_a, n_b = cut_a - first_a, cut_b - first_b
        owner = np.searchsorted(unit_ends, ends)
        by_unit = lambda x: np.bincount(owner, x, len(units)).astype(np.int64)
        counts = np.stack([by_unit(n_a), by_unit(n_b), np.bincount(owner, minlength=len(units)), by_unit(n_a * n_b)], axis=1)
        # links: every A token as often as its group has B tokens
        group = np.repeat(np.arange(len(ends)), n_a)
        times = n_b[group]
        left = np.repeat(a, times)
        start = np.concatenate([[0], np.cumsum(times)])[:-1]
        right = b[np.repeat(first_b[group] - start, times) + np.arange(len(left))]
        key, often = np.unique(np.repeat(owner[group], times) * (len(self.a_bytes) * self.size_b) + left * self.size_b + right, return_counts=True)
        of = key // (len(self.a_bytes) * self.size_b)
        # groups as text: tokens of A and B of one group after the other
        ordered = np.empty(len(a) + len(b), np.int64)
        group_b = np.repeat(np.arange(len(ends)), n_b)
        ordered[np.arange(len(a)) + first_b[group]] = 2 * a + (np.arange(len(a)) + 1 == cut_a[group])
        ordered[np.arange(len(b)) + cut_a[group_b]] = 2 * (len(self.a_bytes) + b) + (np.arange(len(b)) + 1 == cut_b[group_b])
        shown = list(map(self.shown.__getitem__, ordered.tolist()))
        stop = (cut_a + cut_b)[last].tolist()
        groups = ["".join(shown[lo:hi])[:-1] for lo, hi in zip([0, *stop], stop)]
        return Units(counts, groups, np.bincount(of, minlength=len(units)), key % (len(self.a_bytes) * self.size_b), often)

    def forget(self, all_units: bool = False) -> None:
        """Drop the units if there are too many of them, or all; numbers given before are void."""
        if all_units or len(self.known) > KNOWN_UNITS or self.chars > KNOWN_CHARS:
            self.known, self.units, self.chars = {}, NONE, 0

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The number of the unit of every string."""
        new = [s for s in dict.fromkeys(strings) if s not in self.known]
        if new:
            parts, held, size = [self.units], [], 0
            plain, other = [], []
            for s in new:
                (plain if self.cuts and s and s == s.strip() and BLANK not in s else other).append(s)
            for s in plain:
                held.append(s)
                size += len(s)
                if size >= BATCH_CHARS:
                    parts.append(self.align(held))
                    held, size = [], 0
            if held:
                parts.append(self.align(held))
            parts += [self.align([s]) for s in other]
            self.known.update(zip([*plain, *other], range(len(self.known), len(self.known) + len(new)), strict=True))
            self.chars += sum(map(len, new))
            self.units = _joined(parts)
        return np.fromiter(map(self.known.__getitem__, strings), np.int64, len(strings))

    def stretches(self, text: str) -> Iterator[str]:
        """The text in pieces that end before a blank between characters."""
        lo = 0
        while lo < len(text):
            found = _BETWEEN.search(text, lo + PIECE_CHARS) if self.cuts and len(text) - lo > PIECE_CHARS else None
            hi = found.start() if found else len(text)
            yield text[lo:hi]
            lo = hi + 1

    def _split(self, text: str) -> list[str]:
        return _BETWEEN.split(text) if self.cuts else [text]

    def of_texts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, str] | None]:
        """Per text: numbers of its distinct units, how often each occurs, and the digest of its groups; None without tokens."""
        short = [self._split(t) if 0 < len(t) <= PIECE_CHARS else [] for t in texts]
        flat = self.numbers([u for units in short for u in units])
        out, at = [], 0
        for text, units in zip(texts, short, strict=True):
            digest, found, bad = hashlib.sha256(), [], not text
            pieces = [flat[at : at + len(units)]] if units else (self.numbers(self._split(p)) for p in self.stretches(text))
            at += len(units)
            for k, numbers in enumerate(pieces):
                groups = [self.units.groups[i] for i in numbers.tolist()]
                bad = bad or None in groups
                if not bad:
                    digest.update(((";" if k else "") + ";".join(groups)).encode())
                found.append(np.unique(numbers, return_counts=True))
            if bad:
                out.append(None)
            elif len(found) == 1:
                out.append((*found[0], digest.hexdigest()))
            else:
                distinct, where = np.unique(np.concatenate([d for d, _ in found]), return_inverse=True)
                times = np.bincount(where, np.concatenate([t for _, t in found])).astype(np.int64)
                out.append((distinct, times, digest.hexdigest()))
        return out


def aligner(bytes_path: str, pieces_path: str) -> Aligner:
    """The tokenizers of this Python process.

    Functions travel with the job, and their module's variables with them; what is to outlive a task is kept in a module of its own.
    """
    known = sys.modules.setdefault("_token_aligners", ModuleType("_token_aligners")).__dict__
    key = f"{bytes_path}|{pieces_path}"
    if key not in known:
        known[key] = Aligner(bytes_path, pieces_path)
    return known[key]


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text``, ``copies`` and ``salts`` (the bits of the salts of its documents) of every distinct text that isn't empty."""
    rows = docs.select(_salt(id_col).alias("_bit"), F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    return rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"), F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("salts"))


def _salt(id_col: str):
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int")


_LISTS = {
    "key": pa.binary(), "salts": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "digest": pa.string(), "pair": pa.int64(), "pair_copies": pa.int64(),
}
_PACKED = ("n_units", "unit", "times", "n_pairs", "place", "pair_times")
_SQL = {pa.binary(): "BINARY", pa.int64(): "LONG", pa.string(): "STRING"}
CHUNK_SCHEMA = "chunk BINARY, " + ", ".join([*(f"`{n}` ARRAY<{_SQL[t]}>" for n, t in _LISTS.items()), *(f"`{n}` BINARY" for n in _PACKED)])


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest takes: their width, then one after the other."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _chunk(own: Aligner, texts: list[str], copies: list[int], salts: list[int]) -> pa.RecordBatch:
    """One row: per text its key, measures and units; per unit of the chunk the places of its pairs; and the chunk's distinct pairs, each
    with the number of documents of the chunk that hold it linked."""
    found = own.of_texts(texts)
    none = np.empty(0, np.int64)
    numbers = [f[0] if f else none for f in found]
    chosen, times = np.concatenate(numbers), np.concatenate([f[1] if f else none for f in found])
    sizes = np.array([len(n) for n in numbers])
    used, local = np.unique(chosen, return_inverse=True)
    text = np.repeat(np.arange(len(texts)), sizes)
    sums = np.zeros((len(texts), 4), np.int64)
    np.add.at(sums, text, own.units.counts[chosen] * times[:, None])
    n_pairs = own.units.n_pairs[used]
    at, _ = _spread(own.units.n_pairs, used)
    pairs, place = np.unique(own.units.pairs[at], return_inverse=True)
    pair_times = own.units.times[at]
    at, owner = _spread(n_pairs, local)
    held = np.sort(text[owner] * len(pairs) + place[at])  # not np.unique, whose hash table takes several times as long
    held = held[np.diff(held, prepend=-1) > 0]
    pair_copies = np.zeros(len(pairs), np.int64)
    if len(pairs):
        np.add.at(pair_copies, held % len(pairs), np.array(copies, np.int64)[held // len(pairs)])
    keys = [hashlib.sha256(t.encode()).digest() for t in texts]
    out = dict(zip(_LISTS, [keys, salts, *sums.T, [f[2] if f else "" for f in found], pairs, pair_copies], strict=True))
    packed = [pack(x) for x in (sizes, local, times, n_pairs, place, pair_times)]
    own.forget()
    lists = [pa.ListArray.from_arrays(pa.array([0, len(out[n])], pa.int32()), pa.array(out[n], t)) for n, t in _LISTS.items()]
    return pa.record_batch(
        [pa.array([keys[0]], pa.binary()), *lists, *(pa.array([x], pa.binary()) for x in packed)], names=["chunk", *_LISTS, *_PACKED])


def align_texts(texts: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """Chunks of aligned texts, one row each, named after their first text's key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(bytes_path, pieces_path)
        held: list[tuple[str, int, int]] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(k) for k in range(3)), strict=True):
                held.append(tuple(v.as_py() for v in row))
                size += len(held[-1][0])
                if size >= CHUNK_CHARS:
                    yield _chunk(own, *map(list, zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            yield _chunk(own, *map(list, zip(*held, strict=True)))
        own.forget(all_units=True)

    return texts.select("text", "copies", "salts").mapInArrow(run, CHUNK_SCHEMA)


def _spread(counts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions of the items of the chosen owners, who have ``counts`` items each, and which choice each belongs to."""
    starts = np.concatenate([[0], np.cumsum(counts)])
    size = counts[chosen]
    owner = np.repeat(np.arange(len(chosen)), size)
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    return starts[chosen][owner] + np.arange(len(owner)) - first[owner], owner


def requests(chunks: DataFrame) -> DataFrame:
    """``chunk``, ``pair``, ``copies``: of every chunk's distinct pairs, in how many documents of the chunk each is linked."""
    return chunks.select("chunk", F.inline(F.arrays_zip("pair", "pair_copies")).alias("pair", "copies"))


def measures(chunks: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """Per text its key, salts, measures and digest; and ``pair``, ``a``, ``b``, ``count`` of the corpus."""
    asked = stage(requests(chunks), "pair-requests")
    counts = stage(asked.groupBy("pair").agg(F.sum("copies").alias("count")).select(
        "pair", F.expr(f"pair div {size_b}").alias("a"), F.expr(f"pair % {size_b}").alias("b"), "count"), "pair-counts")
    best = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("most")))  # one row per id of A
    answers = asked.select("chunk", "pair").join(
        counts.join(best, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pair")

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = right.column("pair").to_numpy()
        order = np.argsort(pairs)
        count, top = right.column("count").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        rows = []
        for r in range(left.num_rows):
            n_units, chosen, times, n_pairs, place, often = (unpack(left.column(n)[r].as_py()) for n in _PACKED)
            at = np.searchsorted(pairs[order], left.column("pair")[r].values.to_numpy())[place]
            unit = np.repeat(np.arange(len(n_pairs)), n_pairs)
            worth = np.zeros((2, len(n_pairs)), np.int64)
            if len(at):
                for k, value in enumerate((top, count)):
                    np.add.at(worth[k], unit, often * value[at])
            text = np.repeat(np.arange(len(n_units)), n_units)
            sums = np.zeros((2, len(n_units)), np.int64)
            for k in range(2):
                np.add.at(sums[k], text, times * worth[k][chosen])
            rows.append(pa.table(
                [left.column(n)[r].values for n in ("key", "salts", "n_a", "n_b", "n_groups", "n_links")]
                + [pa.array(sums[0]), pa.array(sums[1]), left.column("digest")[r].values], names=["key", "salts", *MEASURES, "digest"]))
        return pa.concat_tables(rows) if rows else empty

    empty = pa.table([pa.array([], pa.binary()), *[pa.array([], pa.int64())] * (1 + len(MEASURES)), pa.array([], pa.string())],
                     names=["key", "salts", *MEASURES, "digest"])
    schema = "key BINARY, salts LONG, " + ", ".join(f"{m} LONG" for m in MEASURES) + ", digest STRING"
    per_text = chunks.drop("pair_copies").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(answered, schema)
    return per_text, counts


def align_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bytes_path: str = f"{FOLDER}/{BYTES_FILE}",
    pieces_path: str = f"{FOLDER}/{PIECES_FILE}",
) -> tuple[DataFrame, DataFrame]:
    """Id, measures and ``groups_sha256`` of every row; and the pair counts (``a``, ``b``, ``count``)."""
    chunks = stage(align_texts(distinct_texts(docs, id_col, text_col), bytes_path, pieces_path), "aligned-chunks")
    per_text, counts = measures(chunks, aligner(bytes_path, pieces_path).size_b)
    salted = per_text.withColumn("_salt", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit(F.col("salts"), s) == 1))).drop("salts")
    rows = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(F.col(text_col).cast("string"), 256)).alias("_key"), _salt(id_col).alias("_own"))
    joined = rows.join(salted, (F.col("_key") == F.col("key")) & (F.col("_own") == F.col("_salt")), "left")
    return joined.select(
        F.col("_id").alias(id_col), *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES],
        F.coalesce("digest", F.lit("")).alias("groups_sha256")), counts.select("a", "b", "count")
