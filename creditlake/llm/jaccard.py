"""N-gram Jaccard join with PartEnum signatures.

A text is the set of its word shingles, as 64-bit hashes. Two sets whose Jaccard
similarity is at least t differ in at most k = (1 - t) / (1 + t) (|u| + |v|)
shingles. Sets are compared within bands of size; the shingle domain is cut into
hash ranges, more than k of them per band, so that two similar sets agree in at
least one range that is not empty, and the hash of what a set has in one range is
a signature. Small sets take every shingle as a range of its own.

A set with m ranges that are not empty agrees with a similar one in m - k of
them. Whatever the common order of all signatures, both therefore have a common
one among their first k + 1, and only those are used. The order puts signatures
that very many sets share (passages, boilerplate) last; the list of these is
bounded and chooses the order only, never which pairs are found. For sets of 64
shingles and more, that m exceeds k is certain but for a chance of about 1e-10.

Exact copies are one set. Signatures that the same sets share count once. Sets
that share a signature are compared by the parities of their shingles per hash
range, some hundred bytes: every different shingle changes one parity, so a pair
that differs in more than k of them is dropped, which is exact. Blocks of sets
meet blocks of sets inside tasks, and no row is made per pair: first a few sets of
a group lead and every other set keeps the nearest of them; then, in rounds, each
set outside of its group's largest component keeps the nearest set of another
component; when none of these is similar by its full sets, all pairs that the
parities still allow are compared by them. Groups of one component are done.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import stage
from .common import BATCH_ROWS, LOWER, MAP_BITS, arrow_map, bit_map, in_map, may_match, send
from .components import joined_components

U = np.uint64
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U)


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    small: int = 64  # below it, every shingle is a range
    ranges: float = 0.75  # ranges of a band, as a share of its smallest size
    most_common: int = 50_000  # bound of the list of common signatures
    common: int = 200  # sets that share a common signature
    flush: int = 2_000_000
    most_bits: int = 4096  # of the parities that travel with each signature; a power of 2, 256 at least
    block: int = 1024  # sets that are compared with as many others at once
    pairs: int = 100_000  # compared in one step of a task

    def most_different(self, both: int) -> int:
        return (100 - self.percent) * both // (100 + self.percent)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_sets(texts: list[bytes | None], hashes: WordHashes, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in ascending order, one text after the other, and their numbers.

    A text of fewer words is one shingle of all its words.
    """
    words = [raw.translate(LOWER).split() if raw else [] for raw in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    total = int(n_words.sum())
    if not total:
        return np.empty(0, U), np.zeros(len(texts), np.int64)
    h = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), U, total)
    begins = np.cumsum(n_words) - n_words
    at = max(0, total - shingle + 1)
    windows = np.full(total, shingle, U)
    for j in range(shingle):
        windows[:at] += h[j : j + at] * factor(j)
    for i in np.flatnonzero((n_words > 0) & (n_words < shingle)):
        windows[begins[i]] = n_words[i]
        for j in range(n_words[i]):
            windows[begins[i] : begins[i] + 1] += h[begins[i] + j : begins[i] + j + 1] * factor(j)
    windows = mix(windows)
    sizes = np.where(n_words < shingle, np.minimum(n_words, 1), n_words - shingle + 1)
    new = np.zeros(total, bool)
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        if size:
            part = windows[begin : begin + size]
            part.sort()
            new[begin] = True
            new[begin + 1 : begin + size] = part[1:] != part[:-1]
    distinct = np.add.reduceat(np.append(new, False), np.minimum(begins, total), dtype=np.int64)
    return windows[new], np.where(n_words > 0, distinct, 0)


def factor(j: int) -> np.ndarray:
    return FACTORS[j % len(FACTORS)] + np.full(1, 2 * (j // len(FACTORS)), U)


def parts_of(shingles: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(sizes)
    return [shingles[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def set_key(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def parities(shingles: np.ndarray, most_bits: int = 1 << 40) -> bytes:
    """The parity of the number of shingles in each of 2^b hash ranges, two to four per shingle, at most ``most_bits``."""
    b = min(max(8, (2 * len(shingles) - 1).bit_length()), most_bits.bit_length() - 1)
    return np.packbits(np.bincount((shingles >> U(64 - b)).astype(np.int64), minlength=1 << b) & 1).tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of different shingles."""
    if len(a) < len(b):
        a, b = b, a
    x = np.unpackbits(np.frombuffer(a, np.uint8))
    y = np.unpackbits(np.frombuffer(b, np.uint8))
    return int((np.bitwise_xor.reduce(x.reshape(len(y), -1), axis=1) ^ y).sum())


def bands_of(sizes: np.ndarray, s: Settings) -> np.ndarray:
    return np.where(sizes < s.small, 0, np.frexp(sizes.astype(np.float64))[1])


def signatures(shingles: np.ndarray, sizes: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signatures, their sets, per set the most by which a similar set can differ), for the band of each
    set and then, for those that have one, for the band below that smaller partners may be in."""
    hashed = mix(shingles + FACTORS[1])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(shingles), dtype=U)
    own, below = bands_of(sizes, s), bands_of(-(-s.percent * sizes // 100), s)
    for bands, wanted in ((own, sizes > 0), (below, (sizes > 0) & (below != own))):
        chosen = wanted[owner]
        if not chosen.any():
            continue
        largest = np.where(bands == 0, s.small - 1, (np.int64(1) << bands) - 1)  # of the smaller set of a pair
        partner = np.where(sizes <= largest, 100 * sizes // s.percent, largest)
        most = (100 - s.percent) * (sizes + partner) // (100 + s.percent)
        ranges = np.where(bands == 0, 0, s.ranges * (np.int64(1) << np.maximum(bands - 1, 0))).astype(U)
        of, mine = owner[chosen], shingles[chosen]
        which = np.where(bands[of] == 0, place[chosen], (mine >> U(32)) * ranges[of] >> U(32))
        starts = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (of[1:] != of[:-1])))
        of = of[starts]
        yield mix(np.add.reduceat(hashed[chosen], starts) + FACTORS[2] * bands[of].astype(U)), of, most


def chosen_signatures(
    shingles: np.ndarray, sizes: np.ndarray, s: Settings, common: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signatures, their sets, which are common): the first most + 1 of each set and band in the common order."""
    for found, of, most in signatures(shingles, sizes, s):
        late = np.zeros(len(found), bool)
        if len(common):
            late = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        kept = np.zeros(len(found), bool)
        some_late = np.logical_or.reduceat(late, starts)
        for a, b, mixed in zip(starts.tolist(), [*starts[1:].tolist(), len(found)], some_late.tolist(), strict=True):
            k = int(most[of[a]]) + 1
            if mixed:
                order = np.lexsort((found[a:b], late[a:b]))
                found[a:b], late[a:b] = found[a:b][order], late[a:b][order]
            else:
                found[a:b].sort()
            kept[a : a + min(k, b - a)] = True
        yield found[kept], of[kept], late[kept]


FACT_FIELDS = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("key", T.LongType()),
    T.StructField("parity", T.BinaryType()),
    T.StructField("sketch", T.BinaryType()),
    T.StructField("sig", T.LongType()),
    T.StructField("seen", T.LongType()),
]


def facts(docs: DataFrame, s: Settings) -> DataFrame:
    """One row per document (``sig`` null), and counts of signatures that several sets of a task share."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *FACT_FIELDS])

    def work(batches):
        hashes = WordHashes()
        held: list[np.ndarray] = []
        met: set = set()
        size = 0
        names = schema.names

        def counted(ids_type):
            values, seen = np.unique(np.concatenate(held), return_counts=True)
            values, seen = values[seen > 3].view(np.int64), seen[seen > 3]
            none = [pa.nulls(len(values), t) for t in (ids_type, pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            return pa.RecordBatch.from_arrays([*none, pa.array(values), pa.array(seen, pa.int64())], names)

        kind = None
        for batch in batches:
            ids, kind = batch.column(0), batch.column(0).type
            shingles, sizes = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), hashes, s.shingle)
            sets = parts_of(shingles, sizes)
            keys = [set_key(x) if len(x) else None for x in sets]
            fresh = np.array([k is not None and k not in met for k in keys])
            met.update(keys)
            none = [pa.nulls(len(ids), pa.int64())] * 2
            long = [parities(x) if 2 * len(x) > s.most_bits else None for x in sets]
            short = [parities(x, s.most_bits) if len(x) else None for x in sets]
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(long, pa.binary()), pa.array(short, pa.binary())]
            yield pa.RecordBatch.from_arrays([ids, *made, *none], names)
            for found, of, _ in signatures(shingles, sizes, s):
                held.append(found[fresh[of]])
                size += len(held[-1])
            if size > s.flush:
                yield counted(kind)
                held.clear()
                met.clear()
                size = 0
        if held:
            yield counted(kind)

    return arrow_map(docs.select("doc_id", "text"), work, schema)


def common_signatures(rows: DataFrame, s: Settings) -> np.ndarray:
    """The signatures that most sets share, at most ``most_common``, ascending."""
    counts = rows.filter("sig IS NOT NULL").groupBy("sig").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= s.common)
    top = counts.orderBy(F.desc("seen"), "sig").limit(s.most_common).select("sig").toPandas()["sig"]
    return np.sort(top.to_numpy(np.int64).view(U))


def memberships(docs: DataFrame, common: np.ndarray, s: Settings) -> DataFrame:
    """(sig, key) of the signatures that at least two sets share.

    Signatures that the same sets share become one: a hash of these sets. Should
    two hashes be equal, their groups are compared as one.
    """
    sent = send(docs.sparkSession, common)
    schema = "sig long, key long, common boolean"

    def emit(batches):
        hashes, done = WordHashes(), set()
        for batch in batches:
            shingles, sizes = shingle_sets(batch.column(0).cast(pa.binary()).to_pylist(), hashes, s.shingle)
            keys = np.array([set_key(x) if len(x) else 0 for x in parts_of(shingles, sizes)], np.int64)
            fresh = np.array([size > 0 and k not in done for k, size in zip(keys.tolist(), sizes, strict=True)])
            done.update(keys.tolist())
            for found, of, late in chosen_signatures(shingles, sizes, s, sent()):
                taken = fresh[of]
                made = [found[taken].view(np.int64), keys[of[taken]], late[taken]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["sig", "key", "common"])
            if len(done) > 1_000_000:
                done.clear()

    def shared(batches):
        """Rows come sorted: those whose signature belongs to two keys or more, once each."""
        tail = None
        for batch in batches:
            sig, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            late = batch.column(2).to_numpy(zero_copy_only=False)
            if tail is not None:
                sig, key, late = (np.concatenate(x) for x in zip(tail, (sig, key, late), strict=True))
            # The last signature may go on in the next batch: keep two of its keys and the flag that it was shared.
            open_at = int(np.searchsorted(sig, sig[-1], "left")) if len(sig) else 0
            yield from some(sig[:open_at], key[:open_at], late[:open_at])
            tail = sig[open_at:], key[open_at:], late[open_at:]
            if len(tail[0]) > 1 and tail[1][0] != tail[1][-1]:
                yield from some(*tail, whole=False)
                tail = tail[0][-1:], tail[1][-1:], np.ones(1, bool)  # known to be shared; its last key comes again
        if tail is not None:
            yield from some(*tail)

    def some(sig, key, late, whole=True):
        if not len(sig):
            return
        new = np.append(True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))
        sig, key, late = sig[new], key[new], late[new]
        first = np.append(True, sig[1:] != sig[:-1])
        group = np.cumsum(first) - 1
        sizes = np.bincount(group)
        wanted = (sizes > 1)[group] | late
        if whole:
            of_sets = mix(np.add.reduceat(mix(key.view(U) + FACTORS[3]), np.flatnonzero(first)) + FACTORS[4] * sizes.astype(U))
            sig = np.where(np.bincount(group, late)[group] > 0, sig, of_sets.view(np.int64)[group])
        if wanted.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[wanted]), pa.array(key[wanted])], ["sig", "key"])

    rows = arrow_map(docs.select("text").filter("text IS NOT NULL"), emit, schema)
    # Common signatures are known to be shared, so their rows need not meet.
    salt = F.when(F.col("common"), F.pmod(F.xxhash64("key"), F.lit(1024))).otherwise(0)
    dealt = rows.repartition("sig", salt).sortWithinPartitions("sig", "key")
    return arrow_map(dealt, shared, "sig long, key long").distinct()


def candidate_sets(docs: DataFrame, names: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """(key, shingles) of the sets in ``wanted`` (``key``), each from a document that ``names`` gives, or from one without id."""
    known = stage(names.join(wanted, "key", "left_semi"))
    place = F.xxhash64("doc_id")
    # One map of the ids and the keys; a null id is a value of it like others.
    held = send(docs.sparkSession, bit_map(known.select(F.explode(F.array(place, "key")).alias("key")), MAP_BITS))

    def work(batches):
        hashes, bits = WordHashes(), held()
        for batch in batches:
            texts = batch.column(0).filter(pa.array(in_map(bits, batch.column(1).to_numpy())))
            sets = parts_of(*shingle_sets(texts.cast(pa.binary()).to_pylist(), hashes, s.shingle))
            keys = np.array([set_key(x) for x in sets], np.int64)
            chosen = np.flatnonzero(in_map(bits, keys)).tolist()
            made = [pa.array(keys[chosen]), pa.array([sets[i].tobytes() for i in chosen], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, ["key", "shingles"])

    texts = docs.filter("text IS NOT NULL").select("text", place)
    # A doc_id may stand for several texts, and rows without id come with all their sets.
    return arrow_map(texts, work, "key long, shingles binary").join(known, "key", "left_semi").dropDuplicates(["key"])


def folded(sketches: np.ndarray) -> np.ndarray:
    """The parities (rows of bytes) of half as many ranges."""
    bits = np.unpackbits(sketches, axis=1).reshape(len(sketches), -1, 2)
    return np.packbits(bits[:, :, 0] ^ bits[:, :, 1], axis=1)


class Sketches:
    """Parities of some sets, at their own width and at half of it."""

    def __init__(self, sketches: list[bytes]) -> None:
        self.width = np.array([len(v) for v in sketches], np.int64)
        self.place = np.zeros(len(sketches), np.int64)
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        for width in np.unique(self.width).tolist():
            of = np.flatnonzero(self.width == width)
            self.place[of] = np.arange(len(of))
            full = np.frombuffer(b"".join([sketches[i] for i in of.tolist()]), np.uint8).reshape(-1, width)
            self.rows[width, width] = full.view(U)
            self.rows[width, width // 2] = folded(full).view(U)

    def distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``parity_distance`` of pairs of places whose widths are equal or one twice the other."""
        found = np.zeros(len(x), np.int64)
        wide = self.width[x] * (1 << 32) + self.width[y]
        for both in np.unique(wide).tolist():
            of = np.flatnonzero(wide == both)
            a, b = both >> 32, both & 0xFFFFFFFF
            least = min(a, b)
            one = self.rows[a, least][self.place[x[of]]]
            two = self.rows[b, least][self.place[y[of]]]
            found[of] = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
        return found


def candidates(active: DataFrame, sketches: DataFrame, s: Settings, way: str) -> DataFrame:
    """(a, b, wide): pairs of sets of one group and different labels that the parities allow.

    ``active`` holds (sig, key, label, top, outside, n). With ``way`` "first" a
    few sets of each group meet all others and each set takes the nearest it
    meets; with "nearest" each set outside of its group's largest label takes the
    nearest set of another label; "all" gives all pairs. Groups are compared in
    blocks of a fixed number of sets, without a row per pair. ``wide`` pairs are
    of long sets, whose parities are cut to ``most_bits``.
    """
    at, blocks = F.xxhash64(F.lit(7), "key"), lambda n: F.ceil(F.col(n) / F.lit(s.block)).cast("int")
    if way == "first":
        # The same sets lead in all groups that they are in.
        leads = active.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30) * F.col("n") < 3.0)
        n_out = F.lit(1)
    else:
        leads = active.filter("label <> top")
        n_out = F.greatest(blocks("outside"), F.lit(1))
    n_in = blocks("n")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    x = leads.select("sig", "key", "label", F.pmod(at, n_out).cast("int").alias("i"), every(n_in).alias("j"), F.lit(True).alias("leads"))
    y = active.select("sig", "key", "label", every(n_out).alias("i"), F.pmod(at, n_in).cast("int").alias("j"), F.lit(False).alias("leads"))
    rows = x.union(y).join(sketches, "key").select("sig", "i", "j", "leads", "key", "label", "n_shingles", "cut", "sketch")

    def work(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 4 * BATCH_ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                cell = cells(table)
                end = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
                if end:
                    yield from compare(table.slice(0, end), cell[:end])
                    held = table.slice(end).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from compare(table, cells(table))

    def cells(table):
        """Numbers of the cells (sig, i, j) in the order of the rows."""
        sig, i, j = (table.column(c).to_numpy() for c in range(3))
        new = (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        return np.cumsum(np.append(0, new)) if len(sig) else np.empty(0, np.int64)

    def compare(table, cell):
        if not table.num_rows:
            return
        leads, key, label, size, cut = (table.column(c).to_numpy() for c in range(3, 8))
        known = Sketches(table.column(8).to_pylist())
        x, y = np.flatnonzero(leads), np.flatnonzero(~leads)
        first, last = np.searchsorted(cell[y], cell[x], "left"), np.searchsorted(cell[y], cell[x], "right")
        done = np.append(0, np.cumsum(last - first))
        begin = 0
        while begin < len(x):
            end = max(begin + 1, int(np.searchsorted(done, done[begin] + s.pairs, "right")) - 1)
            n = (last - first)[begin:end]
            px = np.repeat(x[begin:end], n)
            py = y[np.repeat(first[begin:end] - (done[begin:end] - done[begin]), n) + np.arange(len(px))]
            begin = end
            both, least = size[px] + size[py], np.minimum(size[px], size[py])
            ok = (label[px] != label[py]) & (100 * least >= s.percent * (both - least))
            px, py, both = px[ok], py[ok], both[ok]
            distance, most = known.distances(px, py), (100 - s.percent) * both // (100 + s.percent)
            ok = distance <= most
            px, py, share = px[ok], py[ok], distance[ok] / np.maximum(most[ok], 1)
            if way == "first":
                px, py = py, px
            if way != "all" and len(px):
                order = np.lexsort((key[py], share, key[px]))
                order = order[np.append(True, np.diff(key[px][order]) != 0)]
                px, py, share = px[order], py[order], share[order]
            if len(px):
                made = [key[px], key[py], cut[px] & cut[py], share]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in made], ["node", "other", "wide", "share"])

    dealt = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    met = arrow_map(dealt, work, "node long, other long, wide boolean, share double")
    if way != "all":
        met = met.groupBy("node").agg(F.min(F.struct("share", "other", "wide")).alias("m")).select("node", "m.other", "m.wide")
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "wide").distinct()


def pair_filter(pairs: DataFrame, values: DataFrame, column: str, test) -> DataFrame:
    """The rows of ``pairs`` (``a``, ``b``) whose two ``column`` values of ``values`` (``key``) pass ``test``."""
    of = lambda side: values.select(F.col("key").alias(side), F.col(column).alias(f"_{side}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "_a", "_b")

    def work(batches):
        for batch in batches:
            passed = [test(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return arrow_map(joined, work, "a long, b long")


def set_components(docs: DataFrame, rows: DataFrame, s: Settings) -> DataFrame | None:
    """(key, label) of the sets that are similar to others, by what links reach; None when there are none."""
    members = stage(memberships(docs, common_signatures(rows, s), s))
    if members.isEmpty():
        return None
    wanted = stage(members.select("key").distinct())
    facts_of = rows.filter("sig IS NULL AND key IS NOT NULL").join(wanted, "key", "left_semi")
    facts_of = facts_of.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("parity").alias("parity"), F.max("sketch").alias("sketch")
    )
    facts_of = stage(facts_of)
    names = facts_of.select("key", "doc_id")
    sketches = facts_of.select("key", "n_shingles", F.expr("parity IS NOT NULL").alias("cut"), "sketch")
    parities_of = facts_of.filter("parity IS NOT NULL").select("key", F.struct("n_shingles", "parity").alias("sketch"))

    def near(x, y):
        return parity_distance(x["parity"], y["parity"]) <= s.most_different(x["n_shingles"] + y["n_shingles"])

    def similar(x, y):
        x, y = np.frombuffer(x, U), np.frombuffer(y, U)
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= s.percent * (len(x) + len(y) - common)

    def confirmed(pairs):
        """The pairs whose full sets are similar."""
        wide = pairs.filter("wide").select("a", "b")
        close = pairs.filter("NOT wide").select("a", "b")
        if not wide.isEmpty():
            close = stage(close.union(pair_filter(wide, parities_of, "sketch", near)))
        both = close.select(F.col("a").alias("key")).union(close.select(F.col("b").alias("key"))).distinct()
        return stage(pair_filter(close, stage(candidate_sets(docs, names, both, s)), "shingles", similar))

    labels: DataFrame | None = None
    way = "first"
    while True:
        if labels is None:
            known = members.withColumn("label", F.col("key"))
        else:
            of_keys = labels.toDF("key", "label")
            known = stage(members.join(of_keys, "key", "left").withColumn("label", F.coalesce("label", "key")))
        groups = (
            known.groupBy("sig", "label")
            .agg(F.count("*").alias("m"))
            .groupBy("sig")
            .agg(
                F.max_by("label", F.struct("m", "label")).alias("top"),
                (F.sum("m") - F.max("m")).alias("outside"),
                F.sum("m").alias("n"),
            )
            .filter("outside > 0")
        )
        active = stage(known.join(groups, "sig"))
        if active.isEmpty():
            break
        pairs = stage(candidates(active, sketches, s, way))
        if pairs.isEmpty():
            if way == "first":
                way = "nearest"
                continue
            break  # no pair is left that the parities allow
        new = confirmed(pairs)
        any_new = not new.isEmpty()
        if any_new:
            labels = joined_components(labels, new)
        if way == "all":
            break
        # Once no nearest set is similar, what the parities still allow is compared pair by pair.
        way = "nearest" if any_new or way == "first" else "all"
        members = active.select("sig", "key")
    return None if labels is None else labels.toDF("key", "label")


def jaccard_components(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): (doc_id, n_shingles, component_id, set_id).

    ``component_id`` is the smallest doc_id that links reach. A null or empty text
    has no shingles and is its own component. Repeated rows are exact copies of
    one another; null ids take part but name no component unless all ids of it
    are null. Other columns are ignored.
    """
    s = settings or Settings()
    rows = stage(facts(docs, s))
    labels = set_components(docs, rows, s)
    sets = rows.filter("sig IS NULL")
    smallest = sets.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    if labels is None:
        of_set = smallest.withColumn("component_id", F.col("first"))
    else:
        labelled = stage(smallest.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")))
        first_of = stage(labelled.groupBy("label").agg(F.min("first").alias("component_id")))
        of_set = labelled.join(first_of, "label")
    of_set = stage(of_set.select("key", "component_id"))
    return sets.join(of_set, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("key").alias("set_id"),
    )


def one_of_each_group(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, all columns as they were.

    Rows that share a doc_id stand or fall together, by their smallest component.
    """
    found = jaccard_components(docs, settings)
    gone = stage(found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("c")).filter("c <> doc_id"))
    perhaps = may_match(gone, F.xxhash64("doc_id"))(F.xxhash64("doc_id"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rest = docs.filter(perhaps).join(gone.select("doc_id"), "doc_id", "left_anti")
    return docs.filter(~perhaps).select(*columns).union(rest.select(*columns))
