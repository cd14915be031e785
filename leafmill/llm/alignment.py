"""Alignment of two tokenizers' tokens by galloping intersection of their end offsets.

1. Both tokenizers cut a space and the text. Neither lets a token run from a character that
   is no white space into a space, so that words are encoded once per task and looked up
   after that; the ends of a document's tokens are running sums of their bytes.
2. The shorter list of ends drives: from where an end should stand in the longer list, the
   search doubles its stride until the end is passed, then halves the gap. All ends of a
   batch of documents step together. Common ends slice the tokens into groups, and the
   differences of their ranks are each group's ranges of tokens.
3. Every A token of a group is linked to every B token of it. How many documents hold an id
   pair is summed in each task before the shuffle.
4. Documents meet those counts again by buckets of pairs: a bucket's counts are small and
   sorted, documents' pairs stream past them, and sums per document come back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import stored, stored_count
from leafmill.llm.tokens import mixed, python_ready, ranges, text_batches, text_pieces

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: how a byte-level BPE parts a text before merging.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words kept by a task, and their characters; then it starts anew. Longer words are not kept.
CACHE_WORDS, CACHE_CHARS, LONG_WORD = 1_000_000, 1 << 25, 1 << 10
# Words encoded as one text.
JOINED = 128
# Links worked out at once.
CHUNK = 1 << 22
# Pairs of a bucket's counts, and pairs of documents that meet one copy of them, about.
BUCKET_PAIRS, SLICE_PAIRS = 1 << 18, 1 << 23
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_SPACE_SPACE = re.compile(r"\s ")


@dataclass(frozen=True)
class Tokenizers:
    """The two vocabularies, as the bytes of their files."""

    a: bytes
    b: bytes

    @classmethod
    def read(cls, folder: str = TOKENIZERS) -> Tokenizers:
        with open(f"{folder}/{BYTE_BPE}", "rb") as a, open(f"{folder}/{PIECE_BPE}", "rb") as b:
            return cls(a.read(), b.read())


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(0x100) if b not in set(plain))})
    return letters


class Encoder:
    """Both tokenizers, and the words they have met."""

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken

        model = json.loads(files.a)
        letters, special = byte_letters(), {t["id"] for t in model.get("added_tokens", [])}
        entries = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if i not in special}
        # Ids are in the order of the merges, so they serve as ranks.
        self.a = tiktoken.Encoding("a", pat_str=PARTS, mergeable_ranks=entries, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        self.n_a, self.n_b = max(entries.values()) + 1, self.b.get_piece_size()
        self.a_bytes = np.zeros(self.n_a, np.int64)
        for entry, i in entries.items():
            self.a_bytes[i] = len(entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece runs over a space, so words cannot be encoded one by one")
        self.spelt = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_bytes = np.array([len(p) for p in self.spelt], np.int64)
        # Written-out ids with what follows them: inside a range, at its end.
        self.a_inner, self.a_last = self._written(self.n_a, ","), self._written(self.n_a, "|")
        self.b_inner, self.b_last = self._written(self.n_b, ","), self._written(self.n_b, ";")
        self.space = self.b.encode("a ")[1:]
        self._forget()

    @staticmethod
    def _written(n: int, mark: str) -> np.ndarray:
        return np.array([f"{i}{mark}" for i in range(n)], object)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        empty = np.zeros(0, np.int32)
        self.flat, self.at = [empty, empty], [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.same = np.zeros(0, bool)
        # Ids, ends of the words among them, and whether both tokenizers give the words back, of what is being learnt.
        self.fresh: tuple[list, list, list] = [], [], []

    def _learn(self, words: list[str]) -> None:
        """Each word stands for a space and the word. Words that end in no white space are encoded many at a time."""
        plain = [w for w in words if w and not w[-1].isspace() and "▁" not in w]
        others = [w for w in words if not w or w[-1].isspace() or "▁" in w]
        for lo in range(0, len(plain), JOINED):
            run = plain[lo : lo + JOINED]
            joined = " ".join(run)
            a, b = self.a.encode_ordinary(f" {joined}"), self.b.encode(joined)
            if b"".join([self.spelt[i] for i in b]) == b" " + joined.encode():
                ends = np.cumsum([len(w.encode()) + 1 for w in run])
                self._keep(run, [a, b], [np.searchsorted(np.cumsum(size[ids]), ends) + 1 for size, ids in ((self.a_bytes, a), (self.b_bytes, b))], [True] * len(run))
            else:
                others += run
        for w in others:
            a, b = self.a.encode_ordinary(f" {w}"), self.b.encode(w) if w else self.space
            same = b"".join([self.spelt[i] for i in b]) == b" " + w.encode()
            self._keep([w], [a, b], [np.array([len(a)]), np.array([len(b)])], [same])
        for side in (0, 1):
            self.flat[side] = np.concatenate([self.flat[side], *(np.array(x[side], np.int32) for x in self.fresh[0])])
            starts = self.at[side][-1] + np.cumsum([0, *(len(x[side]) for x in self.fresh[0])])
            self.at[side] = np.concatenate([self.at[side], *(starts[i] + x[side] for i, x in enumerate(self.fresh[1]))])
        self.same = np.concatenate([self.same, np.array(self.fresh[2], bool)])
        self.fresh = [], [], []
        self.chars += sum(map(len, words))

    def _keep(self, words: list[str], ids: list[list[int]], ends: list[np.ndarray], same: list[bool]) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.fresh[0].append(ids)
        self.fresh[1].append(ends)
        self.fresh[2].extend(same)

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts, and where each text's start (one more entry at the end), for A and B; a text whose bytes differ has none."""
        if len(self.known) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._forget()
        words: list[str] = []
        counts = []
        for text in texts:
            if text:
                if text[0].isspace() or _SPACE_SPACE.search(text):
                    own = [unit[1:] for unit in _BEFORE_SPACE.split(f" {text}")]
                else:
                    own = text.split(" ")
                words += own
                counts.append(len(own))
            else:
                counts.append(0)
        new = list(dict.fromkeys(w for w in set(words) if w not in self.known))
        self._learn([w for w in new if len(w) <= LONG_WORD])
        kept = len(self.same), [len(x) for x in self.flat]
        if long := [w for w in new if len(w) > LONG_WORD]:
            self._learn(long)
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        of = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[of[~self.same[number]]] = True
        number, of = number[~bad[of]], of[~bad[of]]
        ids, bounds = [], []
        for side in (0, 1):
            first = self.at[side][number]
            sizes = self.at[side][number + 1] - first
            ids.append(self.flat[side][ranges(first, sizes)])
            each = np.bincount(of, sizes, len(texts)).astype(np.int64)
            bounds.append(np.concatenate([[0], np.cumsum(each)]))
        if long:
            self.chars -= sum(map(len, long))
            for w in long:
                del self.known[w]
            self.same = self.same[: kept[0]]
            self.at = [x[: kept[0] + 1] for x in self.at]
            self.flat = [x[:n] for x, n in zip(self.flat, kept[1], strict=True)]
        return ids, bounds


def gallop(needles: np.ndarray, hay: np.ndarray, guess: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each needle the first place in first .. last of the rising `hay` that holds it or more; the last place does.

    Searches start at `guess`, double their stride to either side until the needle is
    enclosed, and then halve the gap. They step together.
    """
    low, high = guess - 1, guess.copy()
    rising = hay[guess] < needles
    low[rising] = guess[rising]
    stride = 1
    going = np.flatnonzero(rising)
    while len(going):
        high[going] = np.minimum(low[going] + stride, last[going])
        going = going[hay[high[going]] < needles[going]]
        low[going] = high[going]
        stride *= 2
    stride = 1
    going = np.flatnonzero(~rising & (low >= first))
    while len(going):
        going = going[hay[low[going]] >= needles[going]]
        high[going] = low[going]
        low[going] = np.maximum(low[going] - stride, first[going] - 1)
        going = going[low[going] >= first[going]]
        stride *= 2
    going = np.flatnonzero(high - low > 1)
    while len(going):
        middle = (low[going] + high[going]) // 2
        above = hay[middle] >= needles[going]
        high[going[above]] = middle[above]
        low[going[~above]] = middle[~above]
        going = going[high[going] - low[going] > 1]
    return high


def common_ends(ends: list[np.ndarray], bounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in A's and B's tokens, just after each end that both have; `ends` rise over all documents together."""
    sizes = [np.diff(b) for b in bounds]
    cuts = []
    for side, leads in ((0, sizes[0] <= sizes[1]), (1, sizes[0] > sizes[1])):
        count = np.where(leads, sizes[side], 0)
        own = ranges(bounds[side][:-1], count)
        rank = ranges(np.zeros_like(count), count)
        first = np.repeat(bounds[1 - side][:-1], count)
        other = np.repeat(sizes[1 - side], count)
        guess = first + rank * other // np.maximum(np.repeat(count, count), 1)
        hay = ends[1 - side]
        place = gallop(ends[side][own], hay, guess, first, first + other - 1)
        hit = hay[place] == ends[side][own] if len(own) else np.zeros(0, bool)
        pair = [own[hit] + 1, place[hit] + 1]
        cuts.append(pair if side == 0 else pair[::-1])
    a, b = (np.concatenate([cuts[0][side], cuts[1][side]]) for side in (0, 1))
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _written_groups(encoder: Encoder, ids: list[np.ndarray], bounds: list[np.ndarray], a_cut: np.ndarray, b_cut: np.ndarray) -> list[str]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`."""
    parts = np.empty(len(ids[0]) + len(ids[1]), object)
    a_size, b_size = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    a_place = np.arange(len(ids[0])) + np.repeat(b_cut - b_size, a_size)
    b_place = np.arange(len(ids[1])) + np.repeat(a_cut, b_size)
    parts[a_place] = encoder.a_inner[ids[0]]
    parts[b_place] = encoder.b_inner[ids[1]]
    parts[a_place[a_cut - 1]] = encoder.a_last[ids[0][a_cut - 1]]
    parts[b_place[b_cut - 1]] = encoder.b_last[ids[1][b_cut - 1]]
    edges = bounds[0] + bounds[1]
    return ["".join(parts[lo:hi].tolist())[:-1] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


def _linked_pairs(ids: list[np.ndarray], a_cut: np.ndarray, b_cut: np.ndarray, of: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, id pair and number of links of every pair linked in a text, in that order; `of` is each group's text."""
    a_size, b_size = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    a_from, b_from = a_cut - a_size, b_cut - b_size
    space = width * height
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(keys: np.ndarray, times: np.ndarray | None) -> None:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        edge = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(edge, append=len(keys)) if times is None else np.add.reduceat(times[order], edge) if len(edge) else times
        found.append((keys[edge], times))

    links = a_size * b_size
    # A group's A tokens are taken apart where it has more links than a chunk.
    share = np.maximum(1, CHUNK // np.maximum(b_size, 1))
    steps = -(-a_size // share)
    group = np.repeat(np.arange(len(links)), steps)
    nth = ranges(np.zeros_like(steps), steps)
    start = a_from[group] + nth * share[group]
    size = np.minimum(share[group], a_cut[group] - start)
    done = np.cumsum(size * b_size[group])
    lo = 0
    while lo < len(group):
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + CHUNK, "right")))
        g, n = group[lo:hi], size[lo:hi] * b_size[group[lo:hi]]
        inside = ranges(np.zeros_like(n), n)
        each = np.repeat(np.arange(len(g)), n)
        b = b_from[g][each] + inside % b_size[g][each]
        a = start[lo:hi][each] + inside // b_size[g][each]
        add(of[g][each] * space + ids[0][a].astype(np.int64) * height + ids[1][b], None)
        lo = hi
    if len(found) > 1:
        keys, times = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        add(keys, times)
    keys, times = found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return keys // space, keys % space, times


_ENCODERS: dict[bytes, Encoder] = {}


def encoder_of(files: Tokenizers) -> Encoder:
    """This process's encoder of these files, words and all."""
    name = hashlib.sha256(files.a + files.b).digest()
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(files)
    return _ENCODERS[name]


def _decoded(texts: list[bytes]) -> list[str]:
    """The texts; bytes that are no UTF-8 make a text without tokens."""
    out = []
    for text in texts:
        try:
            out.append(text.decode())
        except UnicodeDecodeError:
            out.append("")
    return out


@dataclass
class _Aligned:
    ids: list[np.ndarray]
    bounds: list[np.ndarray]
    a_cut: np.ndarray
    b_cut: np.ndarray
    of: np.ndarray


def _aligned(encoder: Encoder, texts: list[bytes]) -> _Aligned:
    ids, bounds = encoder.encoded(_decoded(texts))
    ends = [np.cumsum(size[own]) for size, own in ((encoder.a_bytes, ids[0]), (encoder.b_bytes, ids[1]))]
    a_cut, b_cut = common_ends(ends, bounds)
    return _Aligned(ids, bounds, a_cut, b_cut, np.searchsorted(bounds[0], a_cut, "left") - 1)


_DOC = "row long, doc_id {0}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _measured(files, kind: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(files.value)
        row = TaskContext.get().partitionId() << 40
        for batch, texts in text_batches(batches):
            for lo, hi in text_pieces(texts):
                n = hi - lo
                x = _aligned(encoder, texts[lo:hi])
                a_size, b_size = np.diff(x.a_cut, prepend=0), np.diff(x.b_cut, prepend=0)
                n_links = np.zeros(n, np.int64)
                np.add.at(n_links, x.of, a_size * b_size)
                written = _written_groups(encoder, x.ids, x.bounds, x.a_cut, x.b_cut)
                text, pairs, times = _linked_pairs(x.ids, x.a_cut, x.b_cut, x.of, encoder.n_a, encoder.n_b)
                edge = np.searchsorted(text, np.arange(n + 1))
                pairs, times = pairs.astype(kind), times.astype("<u4")
                cut = list(zip(edge[:-1], edge[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(n)),
                        batch.column("doc_id").slice(lo, n),
                        pa.array(np.diff(x.bounds[0])),
                        pa.array(np.diff(x.bounds[1])),
                        pa.array(np.bincount(x.of, minlength=n)),
                        pa.array(n_links),
                        pa.array([hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]),
                        pa.array([pairs[i:j].tobytes() for i, j in cut], pa.binary()),
                        pa.array([times[i:j].tobytes() for i, j in cut], pa.binary()),
                    ],
                    names,
                )
                row += n

    return run


def _held(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, and how many each row has."""
    rows = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.fromiter((len(r) // size for r in rows), np.int64, len(rows))


def _counted(kind: str):
    """Documents per pair, summed over what a task has seen so far whenever that gets long."""

    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(at, np.concatenate(counts)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            own, _ = _held(batch.column("pairs"), kind)
            key, count = np.unique(own, return_counts=True)
            keys.append(key)
            counts.append(count)
            size += len(key)
            if size > CHUNK:
                key, count = summed(keys, counts)
                keys, counts, size = [key], [count], len(key)
                if size > CHUNK // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(count)], ["pair", "docs"])
                    keys, counts, size = [], [], 0
        if size:
            key, count = summed(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(count)], ["pair", "docs"])

    return run


_MEETING = "bucket int, slice int, kind int, pair long, docs long, best boolean, rows binary, sizes binary, pairs binary, times binary"
_MEETING_NAMES = [f.split()[0] for f in _MEETING.split(", ")]


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _counts_to_buckets(buckets: int, slices: int):
    """Every count to each slice of its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            bucket = pa.array(_bucket(batch.column("pair").to_numpy(), buckets), pa.int32())
            none = pa.nulls(n, pa.binary())
            for s in range(slices):
                fixed = [pa.array(np.full(n, v, np.int32)) for v in (s, 0)]
                yield pa.RecordBatch.from_arrays([bucket, *fixed, batch.column("pair"), batch.column("docs"), batch.column("best"), none, none, none, none], _MEETING_NAMES)

    return run


def _documents_to_buckets(kind: str, buckets: int, slices: int):
    """Of a batch of documents the pairs of each bucket, packed in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            pairs, sizes = _held(batch.column("pairs"), kind)
            times, _ = _held(batch.column("times"), "<u4")
            rows = batch.column("row").to_numpy()
            of = np.repeat(np.arange(len(rows)), sizes)
            bucket = _bucket(pairs, buckets)
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
            turn += 1
            packed = []
            for b in np.flatnonzero(np.diff(edge)).tolist():
                own = order[edge[b] : edge[b + 1]]
                held, counts = np.unique(of[own], return_counts=True)
                packed.append((b, rows[held].tobytes(), counts.astype("<u4").tobytes(), pairs[own].tobytes(), times[own].tobytes()))
            n = len(packed)
            columns = list(zip(*packed, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array([(turn + b) % slices for b in columns[0]], pa.int32()),
                    pa.array([1] * n, pa.int32()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.bool_()),
                    *(pa.array(c, pa.binary()) for c in columns[1:]),
                ],
                _MEETING_NAMES,
            )

    return run


def _met(kind: str):
    """Sums per row of the documents' pairs that stream past their bucket's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, table = None, [], None
        for batch in batches:
            # Rows are sorted by bucket, slice and kind; runs of one kind are worked off together.
            key = np.stack([batch.column(c).to_numpy() for c in ("bucket", "slice", "kind")])
            edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                group = tuple(key[:2, lo].tolist())
                if group != now:
                    now, held, table = group, [], None
                if key[2, lo] == 0:
                    held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "docs", "best")])
                    continue
                if table is None:
                    pair, docs, best = (np.concatenate(c) for c in zip(*held, strict=True))
                    order = np.argsort(pair)
                    table, held = (pair[order], docs[order], best[order].astype(bool)), []
                for i in range(hi - lo):
                    own, counts, pairs, times = (
                        np.frombuffer(part.column(c)[i].as_buffer(), k) for c, k in (("rows", "<i8"), ("sizes", "<u4"), ("pairs", kind), ("times", "<u4"))
                    )
                    at = np.searchsorted(table[0], pairs.astype(np.int64))
                    times = times.astype(np.int64)
                    start = np.concatenate([[0], np.cumsum(counts.astype(np.int64))[:-1]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own),
                            pa.array(np.add.reduceat(times * table[2][at], start)),
                            pa.array(np.add.reduceat(times * table[1][at], start)),
                        ],
                        ["row", "n_best", "count_sum"],
                    )

    return run


def _ready(docs: DataFrame, tokenizers: str):
    spark: SparkSession = docs.sparkSession
    python_ready(spark)
    # Vocabularies are a few MB whatever the corpus, and executors need no files of their own.
    return spark.sparkContext.broadcast(Tokenizers.read(tokenizers))


def link_report(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is the number of rows that hold it linked; `n_best` counts the links
    whose pair's count is the highest of its A id (ties included), `count_sum` adds up the
    counts of all links. Texts that are null, empty, or that one of the tokenizers does
    not give back unchanged have no tokens: zeros, and an empty `groups_sha256`. Repeated
    rows are documents of their own; special tokens' names in texts are plain text; other
    columns are left aside; no rows give no rows.
    """
    files = _ready(docs, tokenizers)
    encoder_pairs = encoder_of(files.value)
    kind = "<u4" if encoder_pairs.n_a * encoder_pairs.n_b < 1 << 32 else "<i8"
    height = encoder_pairs.n_b
    shape = _DOC.format(docs.schema["doc_id"].dataType.simpleString())
    names = [f.split()[0] for f in shape.split(", ")]
    measured = stored(docs.select("doc_id", "text").mapInArrow(_measured(files, kind, names), shape), "alignment-documents")
    seen = measured.select("pairs").mapInArrow(_counted(kind), "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    # An A id has at most as many pairs as B has ids.
    most = F.max("docs").over(Window.partitionBy(F.floor(F.col("pair") / height)))
    counts = stored(seen.withColumn("best", F.col("docs") == most), "alignment-counts")
    held = measured.agg(F.coalesce(F.sum(F.octet_length("pairs")), F.lit(0))).first()[0] // np.dtype(kind).itemsize
    buckets = -(-stored_count(counts) // BUCKET_PAIRS) or 1
    slices = -(-held // (buckets * SLICE_PAIRS)) or 1
    tables = counts.mapInArrow(_counts_to_buckets(buckets, slices), _MEETING)
    pairs = measured.select("row", "pairs", "times").mapInArrow(_documents_to_buckets(kind, buckets, slices), _MEETING)
    meeting = tables.unionAll(pairs).repartition(buckets * slices, "bucket", "slice").sortWithinPartitions("bucket", "slice", "kind")
    sums = meeting.mapInArrow(_met(kind), "row long, n_best long, count_sum long").groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    told = measured.drop("pairs", "times").join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"])
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignments(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """One row per document: doc_id, its ids `a` and `b`, and the ranks `a_cuts` and `b_cuts` just after each end that both have.

    Group g holds the tokens from its predecessor's cuts, or 0, up to its own. Nulls and
    texts that a tokenizer changes are as in `link_report`.
    """
    files = _ready(docs, tokenizers)
    shape = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a array<int>, b array<int>, a_cuts array<int>, b_cuts array<int>"

    def lists(flat: np.ndarray, edge: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(flat, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(files.value)
        for batch, texts in text_batches(batches):
            for lo, hi in text_pieces(texts):
                x = _aligned(encoder, texts[lo:hi])
                groups = np.searchsorted(x.of, np.arange(hi - lo + 1))
                cuts = [lists(cut - bound[x.of], groups) for cut, bound in ((x.a_cut, x.bounds[0]), (x.b_cut, x.bounds[1]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), lists(x.ids[0], x.bounds[0]), lists(x.ids[1], x.bounds[1]), *cuts],
                    ["doc_id", "a", "b", "a_cuts", "b_cuts"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, shape)
