"""Substring deduplication: repeated paragraphs by MinHash banding.

Units of a text are its paragraphs (lines of at least five words, a shingle), and windows
of 20 words that begin where the hash of three words is the smallest among 28
neighbouring positions. Such windows do not depend on what surrounds a
passage, so two documents that share 50 words or more share a window, also
inside longer paragraphs. A unit that occurs again is extended to both sides
over the words that are the same around the copy that stays. Shared words
beyond the outermost common window, or between two of them, are fewer than 28
(any 28 neighbouring positions inside a passage have their window in common),
so that many words around a unit settle where its passage begins and ends. Where
a window and the next one lie alike in the copy that stays, and all words
between them are equal by hash, they join without a look at the words around.

Units of equal content meet by two 64-bit hashes. Paragraphs also meet if they
collide in one of 4 bands of 2 MinHashes of their 5-word shingles, which two of
similarity 0.8 do with probability 0.98; collisions are verified by the exact
Jaccard similarity of the shingle sets. Links make components, and of each
component the first unit (smallest doc_id, then position) stays. Crowded bands
are verified block by block, and only a spanning forest of links leaves
(``components.dense_links``).

Most windows occur once. Their signatures alone are counted first, and a bitmap
of the repeated ones keeps the others from ever being shuffled with their
places (``common.picked``); each staged table is dropped after its last use.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import dropped, gives_back, picked, slices, staged, text_or_empty
from starload.llm.components import SMALL_BUCKET, components, dense_links

SHINGLE = 5
SIMILAR = 0.8
BANDS, PER_BAND = 4, 2
WINDOW_WORDS, NEIGHBOURS, ANCHOR_WORDS = 20, 28, 3
MIN_WORDS = SHINGLE
AROUND = NEIGHBOURS - 1  # words on each side of a unit that are compared
HASH_BYTES = 3           # of each of them
RUN = 1 << 20            # bytes of text that are read in one pass
SLAB = 1 << 22

_random = np.random.default_rng(20)
_odd = lambda *shape: _random.integers(0, 2**63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = [int(x) for x in _odd(3)]
ANCHOR, GRAM, WHOLE, PERMUTE = _odd(ANCHOR_WORDS), _odd(SHINGLE), _odd(2, WINDOW_WORDS), _odd(BANDS * PER_BAND)
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_HASHED = np.uint64(2**64 - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse, self.size = base, pow(base, -1, 2**64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 17)
            grow = lambda b: np.cumprod(np.full(self.size, b, np.uint64)) * np.uint64(pow(b, -1, 2**64))
            self.up, self.down = grow(self.base), grow(self.inverse)
        return self.up, self.down


POWERS = [Powers(b) for b in BASES]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of each range of ``values``, the same wherever the range is."""
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, up[:len(values)], out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Texts:
    """Word hashes, lines and windows of some texts (A-Z as a-z), laid end to
    end with a line break between them, so that one pass serves them all."""

    def __init__(self, texts: list[str]):
        data = [t.encode("utf-8").lower() for t in texts]
        self.raw = np.frombuffer(b"\n".join(data), np.uint8)
        begins = np.cumsum([0] + [len(d) + 1 for d in data])[:len(data)]
        space = np.concatenate([[True], IS_SPACE[self.raw], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.n = len(self.starts)
        self.words = range_hashes(self.raw.astype(np.uint64) + np.uint64(1), self.starts, self.ends, POWERS[0])
        # the text of each word, each text's first word and the one past its last
        self.text = np.searchsorted(begins, self.starts, side="right") - 1
        self.first = np.searchsorted(self.starts, begins)
        self.last = np.append(self.first[1:], self.n)[:len(data)]
        # code points that begin before each byte, and before each text
        self.char = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw & 0xC0) != 0x80, out=self.char[1:])
        self.base = self.char[begins]

    def grams(self, factors: np.ndarray) -> np.ndarray:
        """A hash of the len(factors) words from each position."""
        m = self.n - len(factors) + 1
        return mixed(sum(self.words[i:i + m] * f for i, f in enumerate(factors))) if m > 0 else np.empty(0, np.uint64)

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last word of each line of enough words."""
        line = np.searchsorted(np.flatnonzero(self.raw == 10), self.starts)
        cuts = np.flatnonzero(np.diff(line, prepend=-1, append=-2))
        first, last = cuts[:-1], cuts[1:]
        long = last - first >= MIN_WORDS
        return first[long], last[long]

    def anchors(self) -> np.ndarray:
        """First words of the windows: minima of the 3-word hashes among
        NEIGHBOURS positions of a text, or among all that it has."""
        m = self.n - WINDOW_WORDS + 1
        if m <= 0:
            return np.empty(0, np.int64)
        h = self.grams(ANCHOR)[:m]
        low_bits = np.uint64(0xFFFFFF)
        stop = self.last[self.text[:m]] - WINDOW_WORDS + 1
        found = []
        for lo in range(0, m, SLAB):
            part = h[lo:lo + SLAB + NEIGHBOURS - 1]
            if len(part) < NEIGHBOURS:
                break
            low = (part & ~low_bits) | np.arange(len(part), dtype=np.uint64)
            width = 1
            while width < NEIGHBOURS:
                step = min(width, NEIGHBOURS - width)
                low = np.minimum(low[:-step], low[step:])
                width += step
            at = np.arange(lo, lo + len(low))
            least = (low[at + NEIGHBOURS <= stop[at]] & low_bits).astype(np.int64) + lo
            found.append(least[np.diff(least, prepend=-1) != 0])  # they never go back
        n = self.last - self.first - WINDOW_WORDS + 1
        few = self.first[(n > 0) & (n < NEIGHBOURS)]
        if len(few):
            edges = np.stack([few, few + n[(n > 0) & (n < NEIGHBOURS)]], axis=1).ravel()
            low = np.append((h & ~low_bits) | (np.arange(m, dtype=np.uint64) & low_bits), NOT_HASHED)
            least = np.minimum.reduceat(low, edges)[::2]
            found.append(few + ((least - few.astype(np.uint64)) & low_bits).astype(np.int64))
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    def units(self) -> dict[str, np.ndarray]:
        """All lines, which have ``bands``, and then all windows."""
        first, last = self.paragraphs()
        at = self.anchors()
        windows = self.words[at[:, None] + np.arange(WINDOW_WORDS)]
        hashes = [np.concatenate([range_hashes(self.words, first, last, POWERS[1 + i]),
                                  mixed((windows * WHOLE[i]).sum(axis=1, dtype=np.uint64))]) for i in (0, 1)]
        a = np.concatenate([first, at])
        b = np.concatenate([last, at + WINDOW_WORDS]) - 1
        # from each window to the end of the text's next one
        goes_on = self.text[at[:-1]] == self.text[at[1:]]
        stretch = range_hashes(self.words, at[:-1], at[1:] + WINDOW_WORDS, POWERS[1])
        none = np.zeros(min(1, len(at)), np.int64)
        stretch = np.concatenate([np.zeros(len(first), np.uint64), np.where(goes_on, stretch, np.uint64(0)), none.astype(np.uint64)])
        step = np.concatenate([np.full(len(first), -1), np.where(goes_on, np.diff(at), 0), none])
        text = self.text[a]
        return {"text": text, "start": self.char[self.starts[a]] - self.base[text],
                "end": self.char[self.ends[b]] - self.base[text], "sig": hashes[0].view(np.int64),
                "check": hashes[1].view(np.int64), "bands": self.bands(first, last), "word": a - self.first[text],
                "n": b + 1 - a, "step": step, "stretch": stretch.view(np.int64)}

    def bands(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Band keys of each paragraph, one row per paragraph."""
        if not len(first):
            return np.empty((0, BANDS), np.int64)
        grams = self.grams(GRAM)
        edges = np.stack([first, last - SHINGLE + 1], axis=1).ravel()
        closed = edges[-1] < len(grams)
        least = []
        for p in PERMUTE:
            h = mixed(grams * p)
            h = h if closed else np.append(h, NOT_HASHED)
            least.append(np.minimum.reduceat(h, edges)[::2])
        keys = [mixed(least[PER_BAND * i] * PERMUTE[0] + least[PER_BAND * i + 1] + np.uint64(i)) for i in range(BANDS)]
        return np.stack(keys, axis=1).view(np.int64)

    def shingles(self, wanted: list[list[int] | None]) -> list[tuple[int, list[int]]]:
        """(signature, sorted distinct shingle hashes) of each text's wanted lines."""
        sets = [set(w or ()) for w in wanted]
        if not any(sets):
            return []
        first, last = self.paragraphs()
        sigs = range_hashes(self.words, first, last, POWERS[1]).view(np.int64)
        grams = self.grams(GRAM).view(np.int64)
        found = {}
        for i in np.flatnonzero(np.isin(sigs, np.array([*set().union(*sets)], np.int64))).tolist():
            s, t, a, b = int(sigs[i]), self.text[first[i]], first[i], last[i]
            if s in sets[t] and s not in found:
                found[s] = np.unique(grams[a:b - SHINGLE + 1]).tolist()
        return list(found.items())

    def around(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, sig: np.ndarray,
               left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, list[bytes | None], list[bytes | None]]:
        """For the units given (text, code points, signature): which of them the
        texts have, and the packed words before (``left``) and after them."""
        if not self.n:
            return np.empty(0, np.int64), [], []
        starts, ends = self.char[self.starts], self.char[self.ends]
        a, b = np.searchsorted(starts, start + self.base[text]), np.searchsorted(ends, end + self.base[text])
        at = np.flatnonzero((a < self.n) & (b < self.n) & (a <= b))
        a, b = a[at], b[at]
        window = self.words[np.minimum(a[:, None] + np.arange(WINDOW_WORDS), self.n - 1)]
        same = (range_hashes(self.words, a, b + 1, POWERS[1]).view(np.int64) == sig[at]) | (
            mixed((window * WHOLE[0]).sum(axis=1, dtype=np.uint64)).view(np.int64) == sig[at])
        same &= (starts[a] - self.base[text[at]] == start[at]) & (ends[b] - self.base[text[at]] == end[at])
        at, a, b = at[same], a[same], b[same]
        return (at, self.packed(a, -1, starts, left[at]), self.packed(b, 1, ends, right[at]))

    def packed(self, word: np.ndarray, way: int, edges: np.ndarray, asked: np.ndarray) -> list[bytes | None]:
        """Of the AROUND words beyond each ``word``, the nearest first: HASH_BYTES
        bytes of each hash and the code points to its edge from the one before (0:
        no such word), as one byte each, or four where one does not fit."""
        out: list[bytes | None] = [None] * len(word)
        rows = np.flatnonzero(asked)
        x = word[rows, None]
        at = x + way * np.arange(1, AROUND + 1)
        inside = (at >= self.first[self.text[x]]) & (at < self.last[self.text[x]])
        at = np.where(inside, at, x)
        hashes = self.words[at].view(np.uint8).reshape(len(rows), AROUND, 8)[:, :, 8 - HASH_BYTES:]
        hashes = np.where(inside[:, :, None], hashes, 0).astype(np.uint8).reshape(len(rows), -1)
        gaps = np.where(inside, np.abs(np.diff(np.concatenate([edges[x], edges[at]], axis=1), axis=1)), 0)
        wide = gaps.max(axis=1, initial=0) > 255
        for pick, kind in ((~wide, np.uint8), (wide, "<u4")):
            data = np.concatenate([hashes[pick], np.ascontiguousarray(gaps[pick].astype(kind)).view(np.uint8)], axis=1)
            size, blob = data.shape[1], data.tobytes()
            for i, j in enumerate(rows[pick].tolist()):
                out[j] = blob[i * size:(i + 1) * size]
        return out


def unpacked(sides: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash bytes and gaps of packed words, one row each; null has none."""
    values = sides.to_pylist()
    hashes = np.zeros((len(values), AROUND, HASH_BYTES), np.uint8)
    gaps = np.zeros((len(values), AROUND), np.int64)
    for kind in (np.dtype(np.uint8), np.dtype("<u4")):
        size = AROUND * (HASH_BYTES + kind.itemsize)
        rows = [i for i, v in enumerate(values) if v is not None and len(v) == size]
        data = np.frombuffer(b"".join(values[i] for i in rows), np.uint8).reshape(len(rows), size)
        hashes[rows] = data[:, :AROUND * HASH_BYTES].reshape(-1, AROUND, HASH_BYTES)
        gaps[rows] = np.ascontiguousarray(data[:, AROUND * HASH_BYTES:]).view(kind)
    return hashes, gaps


def reaches(own: pa.Array, other: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points from a unit's edge, on its own side and on the other copy's,
    over the words that both have in common."""
    (h, gaps), (other_h, other_gaps) = unpacked(own), unpacked(other)
    equal = (h == other_h).all(axis=2) & (gaps > 0) & (other_gaps > 0)
    shared = np.cumprod(equal, axis=1)
    return (gaps * shared).sum(axis=1), (other_gaps * shared).sum(axis=1)


UNITS = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("sig", pa.int64()),
                   ("check", pa.int64()), ("bands", pa.list_(pa.int64())), ("word", pa.int32()), ("n", pa.int32()),
                   ("step", pa.int32()), ("stretch", pa.int64())])


@gives_back
def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, RUN):
            u = Texts(part.column(1).to_pylist()).units()
            offsets = np.minimum(np.arange(len(u["sig"]) + 1), len(u["bands"])).astype(np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(u["text"])), pa.array(u["start"].astype(np.int32)),
                 pa.array(u["end"].astype(np.int32)), pa.array(u["sig"]), pa.array(u["check"]),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(u["bands"].ravel())),
                 *(pa.array(u[c].astype(np.int32)) for c in ("word", "n", "step")), pa.array(u["stretch"])],
                schema=UNITS)


READ = pa.schema([("sig", pa.int64()), ("check", pa.int64()), ("grams", pa.list_(pa.int64())), ("doc_id", pa.int64()),
                  ("start", pa.int32()), ("end", pa.int32()), ("is_first", pa.bool_()), ("before", pa.binary()),
                  ("after", pa.binary())])
READ_SQL = ("sig long, check long, grams array<long>, doc_id long, start int, end int, is_first boolean, "
            "before binary, after binary")


@gives_back
def _read_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the wanted lines, and the words around the wanted units."""
    for batch in batches:
        for part in slices(batch, RUN):
            texts = Texts(part.column(1).to_pylist())
            if lines := texts.shingles(part.column(2).to_pylist()):
                sigs, grams = zip(*lines)
                columns = {"sig": pa.array(sigs, pa.int64()), "grams": pa.array(grams, pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(sigs), f.type)) for f in READ], schema=READ)
            units = part.column(3).flatten()
            if not len(units):
                continue
            text = part.column(3).value_parent_indices().to_numpy()
            u = {f.name: units.field(f.name) for f in units.type}
            at, before, after = texts.around(text, *(u[c].to_numpy(zero_copy_only=False) for c in (
                "start", "end", "sig", "left", "right")))
            rows = pa.array(at)
            columns = {c: u[c].take(rows) for c in ("sig", "check", "start", "end", "is_first")}
            columns |= {"doc_id": part.column(0).take(pa.array(text[at])), "before": pa.array(before, pa.binary()),
                        "after": pa.array(after, pa.binary()), "grams": pa.nulls(len(at), pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in READ], schema=READ)


LONGER = pa.schema([("sig", pa.int64()), ("check", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()),
                    ("end", pa.int32()), ("first_start", pa.int32()), ("first_end", pa.int32())])


@gives_back
def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units and their firsts over the words that both have around them."""
    for batch in batches:
        for part in slices(batch, 1 << 22):
            get = {c: part.column(c) for c in part.schema.names}
            n = {c: get[c].to_numpy() for c in ("doc_id", "start", "end", "f_doc_id", "f_start", "f_end")}
            left, f_left = reaches(get["before"], get["f_before"])
            right, f_right = reaches(get["after"], get["f_after"])
            start = n["start"] - left
            # in one document, the later copy does not go back into the first
            clipped = np.minimum(n["start"], np.maximum(start, n["f_end"]))
            start = np.where(n["doc_id"] == n["f_doc_id"], clipped, start)
            spans = (start, n["end"] + right, n["f_start"] - f_left, n["f_end"] + f_right)
            yield pa.RecordBatch.from_arrays([get["sig"], get["check"], get["doc_id"],
                                              *(pa.array(x.astype(np.int32)) for x in spans)], schema=LONGER)


def _similar(x: list, y: list) -> np.ndarray:
    """Which pairs of sorted shingle sets have a Jaccard similarity of SIMILAR or more."""
    names = {g: i for i, g in enumerate({g for s in (*x, *y) for g in s})}
    rows = [np.array([names[g] for g in s], np.int64) for s in x]
    sizes = np.array([len(s) for s in y])
    holders: dict[int, list[int]] = {}
    for j, s in enumerate(y):
        for g in s:
            holders.setdefault(names[g], []).append(j)
    lists = {g: np.array(js) for g, js in holders.items()}
    out = np.zeros((len(x), len(y)), bool)
    for i, r in enumerate(rows):
        common = np.zeros(len(y), np.int64)
        for g in r.tolist():
            if g in lists:
                common[lists[g]] += 1
        out[i] = common >= SIMILAR * (len(r) + sizes - common)
    return out


def band_rows(units: DataFrame) -> DataFrame:
    """Signatures in the bands where more than one meets, each with a document that holds it."""
    distinct = units.filter(F.size("bands") > 0).groupBy("sig", "bands").agg(F.min("doc_id").alias("doc_id"))
    rows = distinct.select("sig", "doc_id", F.explode("bands").alias("band"))
    crowd = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return staged(rows.join(crowd, "band"), "bands")


def read_again(texts: DataFrame, rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The texts read once more: for shingles, and for the words around repeated units."""
    wanted = rows.groupBy("doc_id").agg(F.collect_set("sig").alias("wanted"))
    around = repeated.groupBy("doc_id").agg(F.collect_list(
        F.struct("start", "end", "sig", "check", "left", "right", "is_first")).alias("around"))
    found = texts.join(wanted.join(around, "doc_id", "full"), "doc_id").select("doc_id", "text", "wanted", "around")
    return staged(found.mapInArrow(_read_again, READ_SQL), "read_again")


def chained(units: DataFrame, repeats: DataFrame) -> DataFrame:
    """Repeated units other than the first of their content, with that first
    one; ``after`` (end, first_end) tells of the next window if the passage goes
    on to it, ``left`` and ``right`` on which side words have to be compared."""
    rows = units.join(repeats.select("sig", "check", "first"), ["sig", "check"]).filter(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start")))
    is_window = F.col("step") >= 0
    rows = rows.select("sig", "check", "doc_id", "start", "end", "word", "n", "step", "first", is_window.alias("is_window"),
                       (F.col("word") - F.col("first.word")).alias("shift"),
                       (F.col("stretch") == F.col("first.stretch")).alias("alike"))
    alike = W.partitionBy("doc_id", "first.doc_id", "shift")
    down = alike.orderBy(F.desc("word"), F.desc("is_window"), "start").rowsBetween(W.unboundedPreceding, -1)
    up = alike.orderBy("word", "is_window", "start").rowsBetween(W.unboundedPreceding, -1)
    window = F.when(F.col("is_window"), F.struct("word", "end", F.col("first.end").alias("first_end")))
    rows = rows.withColumn("next", F.last(window, ignorenulls=True).over(down))
    goes_on = F.col("is_window") & F.col("alike") & (F.col("step") > 0) & (F.col("next.word") == F.col("word") + F.col("step"))
    rows = rows.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
    before = F.last(F.when(F.col("is_window"), F.struct("word", "step", "goes_on")), ignorenulls=True).over(up)
    rows = rows.withColumn("last", before)
    comes_on = F.coalesce(F.col("last.goes_on") & (F.col("last.word") + F.col("last.step") == F.col("word")), F.lit(False))
    # a paragraph with a window of the same copy in it is inside that window's passage
    held = F.coalesce(F.col("next.word") + WINDOW_WORDS <= F.col("word") + F.col("n"), F.lit(False))
    left = F.when(F.col("is_window"), ~comes_on).otherwise(~held)
    right = F.when(F.col("is_window"), ~F.col("goes_on")).otherwise(~held)
    after = F.when(F.col("goes_on"), F.struct(F.col("next.end").alias("end"), F.col("next.first_end").alias("first_end")))
    first = F.struct("first.doc_id", "first.start", "first.end")
    return staged(rows.select("sig", "check", "doc_id", "start", "end", first.alias("first"), after.alias("after"),
                              left.alias("left"), right.alias("right")).filter("left or right or after is not null"), "chained")


def sought(chain: DataFrame) -> DataFrame:
    """Units around which words are compared: the open ones, and their firsts."""
    rows = chain.filter("left or right").select("sig", "check", "doc_id", "start", "end", "first", "left", "right")
    firsts = rows.groupBy("sig", "check", "first").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    return rows.drop("first").withColumn("is_first", F.lit(False)).unionByName(firsts.select(
        "sig", "check", "first.doc_id", "first.start", "first.end", "left", "right", F.lit(True).alias("is_first")))


def extended(around: DataFrame, chain: DataFrame) -> DataFrame:
    """Repeated units extended over the words they share with the first unit of
    equal content: sig, check, doc_id, start, end, and first_start and
    first_end, which the first unit gets from this one."""
    columns = ("doc_id", "start", "end", "before", "after")
    firsts = around.filter("is_first").select("sig", "check", *[F.col(c).alias(f"f_{c}") for c in columns])
    pairs = around.filter("not is_first").select("sig", "check", *columns).join(firsts, ["sig", "check"])
    longer = pairs.mapInArrow(_longer, "sig long, check long, doc_id long, start int, end int, first_start int, first_end int")
    joins = chain.filter("after is not null").select(
        "sig", "check", "doc_id", "start", F.col("after.end").alias("end"),
        F.col("first.start").alias("first_start"), F.col("after.first_end").alias("first_end"))
    return staged(longer.unionByName(joins), "extended")


def paragraph_links(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified links (a, b) between the signatures of similar paragraphs."""
    small = rows.filter(F.col("size") <= SMALL_BUCKET).select("band", "sig")
    pairs = small.alias("a").join(small.alias("b"), (F.col("a.band") == F.col("b.band")) & (F.col("a.sig") < F.col("b.sig")))
    pairs = pairs.select(F.col("a.sig").alias("a"), F.col("b.sig").alias("b")).distinct()
    pairs = pairs.join(grams.select(F.col("sig").alias("a"), F.col("grams").alias("ga")), "a").join(
        grams.select(F.col("sig").alias("b"), F.col("grams").alias("gb")), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    near = pairs.filter(common >= F.lit(SIMILAR) * (F.size("ga") + F.size("gb") - common)).select("a", "b")
    large = rows.filter(F.col("size") > SMALL_BUCKET).join(grams, "sig").select(
        F.col("band").alias("bucket"), F.col("sig").alias("node"), "grams", "size")
    return near.unionByName(dense_links(large, _similar, "grams"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Repeated passages of documents (doc_id, text).

    One row per repeated passage of a document, that is each run of
    overlapping units that occur again, here or elsewhere, extended over the
    words that their copies share: doc_id, start, end (code points, end
    exclusive), class_id (of the passage's components the smallest number),
    keep_doc_ids (the documents whose copies stay) and removed (units that stay
    and units that do not make separate runs, which may overlap). Documents
    without a repeated passage have no rows; nor have null and short texts.
    Letters differ, cases of A-Z do not. Rows that repeat a doc_id are one
    document, whose equal passages at equal places count once; rows without a
    doc_id take no part.
    """
    docs = docs.filter(F.col("doc_id").isNotNull())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    everything = staged(texts.mapInArrow(
        _units, "doc_id long, start int, end int, sig long, check long, bands array<long>, word int, n int, step int, "
        "stretch long"), "units")
    repeated = staged(everything.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("sig"), "signatures")
    units = staged(picked(everything, "sig", repeated, "sig", keep=F.size("bands") > 0), "repeated_units")
    dropped(everything, repeated)
    place = F.struct("doc_id", "start", "end", "word", "stretch")
    exact = units.groupBy("sig", "check").agg(F.min(place).alias("first"), F.max(place).alias("last"),
                                              F.max(F.size("bands")).alias("bands"))
    twice = (F.col("first.doc_id") != F.col("last.doc_id")) | (F.col("first.start") != F.col("last.start"))
    exact = staged(exact.select("sig", "check", "first", twice.alias("twice"), "bands").filter("twice or bands > 0"), "contents")
    repeats = exact.filter("twice")
    rows = band_rows(units)
    chain = chained(units, repeats)
    again = read_again(texts, rows, sought(chain))
    grams = staged(again.filter("grams is not null").select("sig", "grams").dropDuplicates(["sig"]), "shingles")
    longer = extended(again.filter("grams is null"), chain)
    dropped(again, chain)
    links = staged(components(paragraph_links(rows, grams)), "paragraph_classes")
    dropped(rows, grams)
    exact = exact.join(links, exact["sig"] == links["node"], "left").select(
        "sig", "check", "first", F.coalesce("root", "sig").alias("class_id"),
        (F.col("root").isNotNull() | F.col("twice")).alias("again")).filter("again")
    exact = staged(exact.drop("again"), "unit_classes")
    keep = exact.groupBy("class_id").agg(F.min("first").alias("keep"))
    classes = exact.join(keep, "class_id").select("sig", "check", "class_id", F.struct("keep.doc_id", "keep.start").alias(
        "keep"), (F.col("first") == F.col("keep")).alias("stays"))
    found = units.select("doc_id", "start", "end", "sig", "check").join(classes, ["sig", "check"]).select(
        "doc_id", "start", "end", "class_id", F.col("keep.doc_id").alias("keep_doc_id"),
        ((F.col("doc_id") != F.col("keep.doc_id")) | (F.col("start") != F.col("keep.start"))).alias("removed"))
    # words around a unit are only sure to stay where the first of its content stays
    longer = longer.join(classes.filter("stays"), ["sig", "check"])
    firsts = longer.groupBy("sig", "check").agg(
        F.min("keep").alias("keep"), F.min("first_start").alias("start"), F.max("first_end").alias("end"),
        F.min("class_id").alias("class_id"))
    found = found.unionByName(longer.select(
        "doc_id", "start", "end", "class_id", F.col("keep.doc_id").alias("keep_doc_id"), F.lit(True).alias("removed")))
    found = found.unionByName(firsts.select(
        F.col("keep.doc_id").alias("doc_id"), "start", "end", "class_id", F.col("keep.doc_id").alias("keep_doc_id"),
        F.lit(False).alias("removed")))
    order = W.partitionBy("doc_id", "removed").orderBy("start", "end")
    cut = F.when(F.col("start") <= F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), 0).otherwise(1)
    runs = found.withColumn("cut", cut).withColumn("run", F.sum("cut").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "removed", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("class_id").alias("class_id"),
        F.array_sort(F.collect_set("keep_doc_id")).alias("keep_doc_ids")).select(
        "doc_id", "start", "end", "class_id", "keep_doc_ids", "removed")
