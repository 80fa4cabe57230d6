"""Near-dedup by Order MinHash over five-word shingles, verified by banded alignment.

A shingle is five consecutive words and the number of its earlier occurrences in the document. For each of BANDS
hash functions a document's PICKED smallest shingles are sampled and kept in the order in which the text has them; the
band's key is the hash of that sequence. Two documents share a key with about the chance that they share the
shingles and their order, so the key is sensitive to edits and to moved text: at a similarity of 0.8, 12 bands of 2
miss with a chance of 5e-6.

Copies (equal words in equal order, by a 128-bit hash) are one candidate. In each bucket of a band all members are
paired with two members drawn by hash, the bucket's centres, found by an aggregate that combines on the map side: a
bucket of n members gives 2n pairs, however large it is, and its rows meet the centres in a join that adaptive
execution may split. Different bands draw different centres, so members that are alike are linked on many paths.

An exact finish follows, for near documents that these classes still keep apart. Shingles get one order for the whole
table, rare ones first (by counts in bins over all texts; any order gives the same result). Two sets with a Jaccard
similarity of SIMILARITY share one of their first n - ceil(SIMILARITY * n) + 1 shingles in that order, their prefixes;
documents of different classes that share a shingle of their prefixes are candidates, unless their sizes, the shingle's
places or their parities (see parities) rule SIMILARITY out; what is left is held against wider parities before any
text is fetched. No such pair is left out, so classes are those of comparing
all documents; the number of pairs is not bounded where many documents of different classes share rare shingles.

A candidate pair is a link when the Jaccard similarity of its sets of shingles is at least SIMILARITY, and the
alignment of its words, in a band as wide as the edits that this similarity allows, has an edit similarity
(1 - edits / longer length) of at least SIMILARITY too. Classes are the connected components of links and copies.

Defined results: null and empty texts, and texts of fewer than five words, are near only to their copies; a null id
has a class of its own, null, and is kept; rows that repeat an id are one document in the classes, each with its row.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.components import components
from strandline.llm.hashing import mix, windows, word_hashes
from strandline.llm.store import forget, written
from strandline.llm.text import fresh, whole

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
PICKED = 2
BINS = 1 << 20
PARTS = 256  # ranges of bins
SIGNS = [f"s{k}" for k in range(8)]
SKETCH = "id bigint, copy binary, n_shingles int, bands array<bigint>, prefix array<bigint>, " + ", ".join(f"{c} bigint" for c in SIGNS) + ", wide binary"
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = np.random.default_rng(811).integers(1, 1 << 63, 256, dtype=np.uint64)


def labelled(s: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingles with the number of their earlier occurrences in the same document."""
    order = np.lexsort((s, doc))
    a, d = s[order], doc[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])]) if len(a) else np.zeros(0, bool)
    place = np.arange(len(a))
    out = np.empty(len(s), np.uint64)
    out[order] = mix(a + (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def shingled(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, int]:
    """Shingles of the texts, the text of each, and the number of texts."""
    h, at = word_hashes(texts)
    s, i = windows(h, at, k)
    return s, np.searchsorted(at, i, "right") - 1, len(at) - 1


def sketch(texts, bands: int = BANDS, picked: int = PICKED) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each text's bands, a row each (0 where it has no shingle), and its number of distinct shingles. texts: an array, or what shingled gives for it."""
    s, doc, n_texts = texts if isinstance(texts, tuple) else shingled(texts)
    keys, n = np.zeros((n_texts, bands), np.uint64), np.zeros(n_texts, np.int64)
    if not len(s):
        return keys, n
    some, first, row = np.unique(doc, return_index=True, return_inverse=True)
    order = np.lexsort((s, row))
    new = np.concatenate([[True], (s[order][1:] != s[order][:-1]) | (row[order][1:] != row[order][:-1])])
    n[some] = np.bincount(row[order][new], minlength=len(some))
    s = labelled(s, row)
    place = np.arange(len(s))
    for band in range(bands):
        m = mix(s ^ _SEEDS[band])
        chosen = []
        for _ in range(picked):
            least = np.minimum.reduceat(m, first)
            hit = (m == least[row]) & (m != _TOP)
            p = np.minimum.reduceat(np.where(hit, place, len(s)), first)
            chosen.append(p)
            m[p[p < len(s)]] = _TOP
        key = np.full(len(some), _SEEDS[band] ^ np.uint64(band))
        for p in np.sort(np.stack(chosen), axis=0):
            key = mix(key * np.uint64(0xD1342543DE82EF95) + np.where(p < len(s), s[np.minimum(p, len(s) - 1)], np.uint64(7)))
        keys[some, band] = key
    return keys, n


def _bin(s: np.ndarray) -> np.ndarray:
    return (mix(s) >> np.uint64(44)).astype(np.int64)


def _bin_counts(batches):
    count = np.zeros(BINS, np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            h, at = word_hashes(batch.slice(start, 512).column("text"))
            count += np.bincount(_bin(windows(h, at, SHINGLE)[0]), minlength=BINS)
    # Packed by ranges of bins: a row for each bin of each task cost more in the JVM than the counting.
    yield pa.record_batch([pa.array(range(PARTS), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in np.split(count, PARTS)], pa.binary())], ["part", "counts"])


def _bin_sums(table: pa.Table) -> pa.Table:
    total = np.zeros(BINS // PARTS, np.int64)
    for raw in table.column("counts"):
        total += np.frombuffer(raw.as_buffer(), "<i8")
    some = np.flatnonzero(total)
    return pa.table([pa.array(table.column("part")[0].as_py() * len(total) + some), pa.array(total[some])], ["bin", "n"])


def heavy_bins(slim: DataFrame) -> np.ndarray:
    """Bins of shingles far more frequent than others in slim (id, text), and their counts: two rows."""
    counts = slim.select("text").mapInArrow(_bin_counts, "part int, counts binary").groupBy("part").applyInArrow(_bin_sums, "bin bigint, n bigint")
    counts = written(counts, "bins")
    usual = (counts.agg(F.sum("n")).first()[0] or 0) / BINS
    found = counts.where(F.col("n") >= 2 * usual + 8).collect()
    return np.array([[r["bin"] for r in found], [r["n"] for r in found]], np.int64).reshape(2, -1)


def _distinct(s: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where a text's shingle differs from the one before; both are in order."""
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    return new


def prefixes(texts, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each text, those of bins with small weight first: all of a text's behind those of the one before, and their number."""
    s, doc, n_texts = texts if isinstance(texts, tuple) else shingled(texts)
    order = np.lexsort((s, weight[_bin(s)], doc))
    s, doc = s[order], doc[order]
    new = _distinct(s, doc)
    s, doc = s[new], doc[new]
    n = np.bincount(doc, minlength=n_texts)
    size = np.where(n > 0, n - np.ceil(SIMILARITY * n - 1e-6).astype(np.int64) + 1, 0)
    return s[np.arange(len(s)) - (np.cumsum(n) - n)[doc] < size[doc]], size


def parities(texts) -> tuple[np.ndarray, list[bytes]]:
    """For each text, whether the distinct shingles that fall on each of some bits are odd in number: for 64 * len(SIGNS) bits, as a row of longs, and for 4 to 8 bits a shingle. Bits in which two texts differ are at most as many as the shingles that one of them has alone."""
    s, doc, n_texts = texts if isinstance(texts, tuple) else shingled(texts)
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = _distinct(s, doc)
    s, doc = mix(s[new] ^ _SEEDS[-1]), doc[new]
    bits = 64 * len(SIGNS)
    short = np.bincount(doc * bits + (s % np.uint64(bits)).astype(np.int64), minlength=n_texts * bits) & 1
    wide, at = [], np.searchsorted(doc, np.arange(n_texts + 1))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        n = 1 << max(6, (4 * (b - a) - 1).bit_length())
        wide.append(np.packbits((np.bincount((s[a:b] & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8)).tobytes())
    return np.packbits(short.astype(np.uint8).reshape(-1, bits), axis=1).view("<i8"), wide


def apart(x: bytes, y: bytes) -> int:
    """Number of bits in which two wide parities differ; the longer one is folded to the other's length."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _may_be_near(batches):
    for batch in batches:
        far = [apart(x, y) > (m + n) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6 for x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("pa", "pb", "na", "nb")))]
        yield batch.select(["a", "b"]).filter(pa.array(np.logical_not(far), pa.bool_()))


def _sketches(heavy: np.ndarray):
    def run(batches):
        weight = np.zeros(BINS, np.int64)
        weight[heavy[0]] = heavy[1]
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column("text").cast(pa.binary())
                own = shingled(texts)
                keys, n = sketch(own)
                first, size = prefixes(own, weight)
                signs, wide = parities(own)
                copy = [hashlib.md5(b" ".join(t.split())).digest() for t in texts.to_pylist()]
                lists = [(np.arange(0, keys.size + 1, keys.shape[1]), keys.reshape(-1)), (np.concatenate([[0], np.cumsum(size)]), first)]
                yield pa.record_batch([
                    part.column("id"), pa.array(copy, pa.binary()), pa.array(n.astype(np.int32)),
                    *(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x.view(np.int64))) for ends, x in lists), *(pa.array(np.ascontiguousarray(c)) for c in signs.T), pa.array(wide, pa.binary()),
                ], ["id", "copy", "n_shingles", "bands", "prefix", *SIGNS, "wide"])

    return run


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two sequences, or most + 1 if it is larger: furthest reach on each diagonal of a band of most edits."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    base, inverse = np.uint64(0xD1342543DE82EF95), np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
    size = max(n, m) + 1
    power, back = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x)]), dtype=np.uint64) for x in (base, inverse))
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(x.astype(np.uint64)) * power[: len(x)])]) for x in (a, b)]

    def slide(x: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The reach x on each diagonal k, moved over equal words."""
        left = np.minimum(n - x, m - x - k)
        step = 1 << max(0, int(left.max(initial=0)).bit_length() - 1) if len(left) else 0
        while step:
            y = x + k
            fits = (np.minimum(n - x, m - y) >= step) & (x >= 0) & (y >= 0)
            xs, ys = np.where(fits, x, 0), np.where(fits, y, 0)
            z = np.where(fits, step, 0)
            same = fits & ((sums[0][xs + z] - sums[0][xs]) * back[xs] == (sums[1][ys + z] - sums[1][ys]) * back[ys])
            x = np.where(same, x + step, x)
            step >>= 1
        return x

    reach = slide(np.zeros(1, np.int64), np.zeros(1, np.int64))
    low = np.int64(-(1 << 40))
    for e in range(most + 1):
        if abs(m - n) <= e and reach[m - n + e] >= n:
            return e
        k = np.arange(-e - 1, e + 2)
        wide = np.concatenate([[low, low], reach, [low, low]])
        x = np.maximum(np.maximum(wide[1:-1] + 1, wide[:-2]), wide[2:] + 1)
        x = np.minimum(np.minimum(x, n), m - k)
        reach = np.where((x >= 0) & (x + k >= 0), x, low)
        ok = reach >= 0
        reach[ok] = slide(reach[ok], k[ok])
    return most + 1


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY, k: int = SHINGLE) -> bool:
    """Whether two sequences of word hashes are near (see the module)."""
    sets = [np.unique(windows(x.astype(np.uint64), np.array([0, len(x)]), k)[0]) for x in (a, b)]
    if not all(map(len, sets)):
        return False
    both = len(np.intersect1d(*sets, assume_unique=True))
    if both < least * (len(sets[0]) + len(sets[1]) - both):
        return False
    most = int((1 - least) * max(len(a), len(b)))
    return edits(a, b, most) <= most


def _verify(batches):
    for batch in batches:
        a, b = (batch.column(c).to_pylist() for c in ("wa", "wb"))
        near = [similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(a, b)]
        yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near, pa.bool_()))


def _word_bytes(batches):
    for batch in batches:
        h, at = word_hashes(batch.column("text"))
        raw = h.astype("<u8").tobytes()
        yield pa.record_batch([batch.column("id"), pa.array([raw[8 * x : 8 * y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())], ["id", "w"])


def _by_band(reps: DataFrame) -> DataFrame:
    return reps.where("n_shingles > 0").select("id", "n_shingles", *SIGNS, F.posexplode("bands").alias("band", "key"))


def _alike(x: str, y: str, m: str, n: str):
    """Whether the parities of two sets of m and n shingles allow SIMILARITY: near sets differ in (m + n) * (1 - SIMILARITY) / (1 + SIMILARITY) at most."""
    differ = reduce(add, (F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in SIGNS))
    return differ <= (F.col(m) + F.col(n)) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6


def _pairs(met: DataFrame, centre: str) -> DataFrame:
    """Distinct pairs a < b of a row's id and its centre's whose numbers of shingles and parities allow SIMILARITY."""
    close = (F.least("n_shingles", f"{centre}.n_shingles") >= SIMILARITY * F.greatest("n_shingles", f"{centre}.n_shingles")) & _alike("", f"{centre}.", "n_shingles", f"{centre}.n_shingles")
    return met.where((F.col("id") != F.col(f"{centre}.id")) & close).select(F.least("id", f"{centre}.id").alias("a"), F.greatest("id", f"{centre}.id").alias("b")).distinct()


def candidates(keyed: DataFrame, seed: int = 1) -> DataFrame:
    """Pairs a < b of members of a bucket and its two centres. keyed: id, n_shingles, band, key."""
    draw = lambda k: F.min(F.struct(F.xxhash64(F.lit(seed + k), "band", "id").alias("h"), "id", "n_shingles", *SIGNS))
    centres = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), draw(0).alias("c1"), draw(1).alias("c2")).where("n > 1")
    met = keyed.join(centres, ["band", "key"]).withColumn("c", F.explode(F.array_distinct(F.array(*(F.struct(*(F.col(f"{c}.{x}") for x in ("id", "n_shingles", *SIGNS))) for c in ("c1", "c2"))))))
    return _pairs(met, "c")


def unmet(reps: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs a < b of different classes so far that can be near (see the module). classes: id, label."""
    own = reps.where("n_shingles > 0").join(classes, "id", "left").select("id", F.col("n_shingles").alias("n"), F.coalesce("label", "id").alias("cls"), F.posexplode("prefix").alias("place", "key"))
    own = written(own, "prefixes")
    several = own.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("key")
    rest = written(own.join(several, "key", "left_semi").join(reps.select("id", *SIGNS), "id"), "rest")
    x, y = rest.alias("x"), rest.alias("y")  # x: the smaller set
    c = F.col
    both = SIMILARITY / (1 + SIMILARITY) * (c("x.n") + c("y.n")) - 1e-6  # shingles that near sets share at least
    after = F.least(c("x.n") - c("x.place"), c("y.n") - c("y.place"))  # that may be shared from this one on; a near pair's first shared one always passes
    ahead = (c("x.n") < c("y.n")) | ((c("x.n") == c("y.n")) & (c("x.id") < c("y.id")))
    near = ahead & (c("x.cls") != c("y.cls")) & (c("x.n") >= SIMILARITY * c("y.n") - 1e-6) & (after >= both) & _alike("x.", "y.", "x.n", "y.n")
    out = written(x.join(y, (c("x.key") == c("y.key")) & near).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "unmet")
    forget(own, rest)
    return out


def _plausible(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that wide parities do not rule out."""
    end = lambda c: reps.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("wide").alias(f"p{c}"))
    return written(pairs.join(end("a"), "a").join(end("b"), "b").mapInArrow(_may_be_near, "a bigint, b bigint"), "pairs")


def _words_of(slim: DataFrame, pairs: DataFrame) -> DataFrame:
    """Word hashes of the documents in the pairs. slim: id, text."""
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    # Joins by shuffle at every size: what they move is a fixed share of the input.
    return written(slim.hint("merge").join(asked, "id", "left_semi").mapInArrow(_word_bytes, "id bigint, w binary"), "words")


def _links(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are near."""
    pairs = pairs.select("a", "b")
    both = pairs.hint("merge").join(words.select(F.col("id").alias("a"), F.col("w").alias("wa")), "a").hint("merge").join(words.select(F.col("id").alias("b"), F.col("w").alias("wb")), "b")
    return written(both.mapInArrow(_verify, "a bigint, b bigint"), "links")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each distinct id that is not null: id, class_id (the smallest id of its class)."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text")).where("id is not null")
    sketches = written(slim.mapInArrow(_sketches(heavy_bins(slim)), SKETCH), "sketches")
    # An id whose repeated rows differ in text stands in several classes, which meet in it.
    reps = sketches.groupBy("copy").agg(F.min(F.struct("id", "n_shingles")).alias("r"), F.first("bands").alias("bands"), F.first("prefix").alias("prefix"), *(F.first(c).alias(c) for c in (*SIGNS, "wide")))
    reps = written(reps.select("copy", F.col("r.id").alias("id"), F.col("r.n_shingles").alias("n_shingles"), "bands", "prefix", *SIGNS, "wide"), "representatives")
    pairs = _plausible(reps, candidates(_by_band(reps)))
    words = _words_of(slim, pairs)
    links = _links(words, pairs)
    copies = sketches.select("id", "copy").join(reps.select("copy", F.col("id").alias("rep")), "copy").select("id", "rep").distinct()
    first = components(links.union(copies.where("id <> rep").select("id", "rep")))
    forget(sketches, pairs, words, links)
    others = _plausible(reps, unmet(reps, first))
    words = _words_of(slim, others)
    more = _links(words, others)
    label = lambda end: first.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label"))
    joined = components(more.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")))
    forget(reps, others, words, more)
    own = slim.select("id").distinct().join(first, "id", "left").select("id", F.coalesce("label", "id").alias("class"))
    return own.join(joined.select(F.col("id").alias("class"), F.col("label").alias("wider")), "class", "left").select("id", F.coalesce("wider", "class").alias("class_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, class_id, class_size (distinct ids), kept (the id is the class's smallest)."""
    classes = written(near_classes(docs, id_col, text_col), "classes")
    sizes = written(classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")), "sizes")  # a table of its own, so the join below may split a large class
    rows = docs.select(F.col(id_col).cast("bigint").alias("id")).join(classes, "id", "left").join(sizes, "class_id", "left")
    return rows.select(F.col("id").alias(id_col), "class_id", F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each class: the row with the smallest id, once; rows with a null id stay."""
    key, n = fresh(docs, "key", "n")
    stay = near_classes(docs, id_col, text_col).where("id = class_id").select(F.col("id").alias(key))
    known = docs.join(stay, docs[id_col].cast("bigint") == stay[key], "left_semi")
    once = known.withColumn(n, F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(whole(text_col))))).where(F.col(n) == 1).select(*docs.columns)
    return once.unionByName(docs.where(F.col(id_col).isNull()))
