"""Source divergence audit: how far each source's terms are from another's and from its whole language's.

Sort-based streaming. Tasks cut texts into terms and count them by (lang, term, source, document), some CUT_BYTES of text
at a time, and send these counts packed, in one message for each bin of (lang, term). A bin secondary-sorts its counts by
(lang, term, source, document) and scans the runs for document frequencies and counts. Bins are as many as the texts'
bytes ask for, so what one holds stays bounded. A term that takes more than a bin's share of a cut is hot there: its
documents are dealt over bins by a salt drawn from the document, and its partial runs are added up afterwards; all other
runs are whole as they leave their bin and are not shuffled again. Hot terms are in more documents of one cut than a kept
term needs, so terms are kept or not by exact counts, even where rows of one document lie in different cuts.

Terms in LEAST_DOCS documents or more are kept and sorted again by (lang, term, source), a row a source. A second scan emits terms' sums of pairs of sources. With p(a) the share of a term in source a and z(a) that of an absent term,
the sum over all kept terms of f(p(a), p(b)) is

    sum over terms in both of  f(p(a), p(b)) - f(p(a), z(b)) - f(z(a), p(b)) + f(z(a), z(b))
    + sum over terms in a of  f(p(a), z(b)) - f(z(a), z(b))  + the same for b  + V * f(z(a), z(b))

so a term costs the pairs of the sources that hold it; the second line is worked out from how many terms of a source have
each count. Shares and f are whole numbers throughout; sums are decimals. Every f is below (10^9 + V) squared.

Sources and languages are dimension tables written to the shared folder; Spark broadcasts them only where their size is
below its threshold, and splits the other side by skew where it is not.

Defined results: a null text, lang or source is the empty string; documents are told apart by id inside a (lang, source),
so repeated rows count their terms twice and their document once, and rows without an id are told apart by their texts;
a language without kept terms gives value 0 for all pairs; a language of one source has no pair rows; ties are ranked by
item. An empty table gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.hashing import mix, planes, ragged, unplanes, word_hashes
from strandline.llm.store import forget, written
from strandline.llm.text import whole

LEAST_DOCS = 3
MOST_TERMS = 200
SCALE = 1_000_000_000
#: Text for which there is a bin, text cut at a time, and pairs of sources made at a time.
BIN_BYTES = 12 << 20
LEAST_BINS = 12
CUT_BYTES = 8 << 20
PAIRS_AT_ONCE = 1 << 21
#: Documents of one cut that a hot term has at least, and bins for each salt of its documents: salts are a small part of all bins, as a term takes one row of a document's many.
LEAST_HOT = 64
BINS_A_SALT = 16
LEAST_SALTS = 8

MESSAGES = "bin int, payload binary"
RUNS = "lang string, term string, source string, n_docs bigint, n bigint, lang_docs bigint, lang_n bigint, lead boolean, hot boolean"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, and the number of the text that each is from."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    inside = _TERM[raw]
    begins, ends = inside.copy(), inside.copy()  # a term's first byte; its last
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    letters = _FOLD[raw[inside]]
    terms = pa.Array.from_buffers(pa.large_utf8(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return terms, np.searchsorted(at, start, "right") - 1


def _codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where rows differ from those before them in any key, the first row included."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _message(header: dict, terms: list[str], runs: list[np.ndarray], pairs: list[np.ndarray]) -> bytes:
    """Counts of some terms, compressed: numbers in byte planes, names in a header, terms (which hold no line feed) in lines."""
    parts = [json.dumps(header | {"runs": len(terms), "pairs": len(pairs[0])}).encode(), "\n".join(terms).encode("utf-8", "surrogatepass"), *(planes(x, 4) for x in runs), *(planes(x, w) for x, w in zip(pairs, (4, 8, 4)))]
    raw = b"".join(len(x).to_bytes(4, "little") + x for x in parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(message: bytes) -> tuple[dict, list[str], list[np.ndarray], list[np.ndarray]]:
    raw, parts, at = pa.decompress(message[8:], int.from_bytes(message[:8], "little"), codec="zstd", asbytes=True), [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 4], "little")
        parts.append(raw[at + 4 : at + 4 + n])
        at += 4 + n
    return json.loads(parts[0]), parts[1].decode("utf-8", "surrogatepass").split("\n"), [unplanes(x, 4) for x in parts[2:5]], [unplanes(x, w) for x, w in zip(parts[5:], (4, 8, 4))]


def _cut(bins: int, salts: int, least_hot: int):
    def messages(part: pa.RecordBatch):
        terms, of = terms_of(part.column("text"))
        coded = terms.dictionary_encode()
        code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        (lang, langs), (source, sources) = _codes(part.column("lang")), _codes(part.column("source"))
        doc, docs = part.column("doc").to_numpy(zero_copy_only=False), part.num_rows
        order = np.lexsort((doc, source, lang))
        rank = np.empty(docs, np.int64)
        rank[order] = np.arange(docs)
        token = np.sort(code * docs + rank[of])  # by term, lang, source, document
        first = np.flatnonzero(_starts(token))
        n, (code, row) = np.diff(np.append(first, len(token))), np.divmod(token[first], docs)
        row = order[row]
        lang, source, doc = lang[row], source[row], doc[row]
        begin = np.flatnonzero(_starts(code, lang))
        if not len(begin):
            return
        run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(code))))
        held = np.add.reduceat(_starts(code, lang, source, doc).astype(np.int64), begin)
        hot = (held >= max(least_hot, len(code) // bins))[run]
        key = word_hashes(names)[0] if len(names) else np.zeros(0, np.uint64)
        key = mix(key[code] + np.array([zlib.crc32(x.encode("utf-8", "replace")) for x in langs], np.uint64)[lang])
        salt = mix(doc.astype(np.uint64)) % np.uint64(salts) + np.uint64(1)
        at = (mix(key + np.where(hot, salt, np.uint64(0))) % np.uint64(bins)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        edge = np.flatnonzero(_starts(at[order]))
        header = {"langs": langs, "sources": sources}
        for own in np.split(order, edge[1:]):
            start = np.flatnonzero(_starts(code[own], lang[own]))
            some = own[start]
            runs = [np.diff(np.append(start, len(own))), lang[some], hot[some].astype(np.int64)]
            yield int(at[own[0]]), _message(header, names.take(pa.array(code[some])).to_pylist(), runs, [source[own], doc[own], n[own]])

    def run(batches):
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = np.unique(np.searchsorted(size, np.arange(CUT_BYTES, size[-1] if len(size) else 0, CUT_BYTES), "right"))
            for a, b in zip([0, *edges], [*edges, len(size)]):
                if b > a:
                    out = list(messages(batch.slice(a, b - a)))
                    yield pa.record_batch([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bin", "payload"])

    return run


def _merged(table: pa.Table) -> pa.Table:
    """The runs of one bin, from the messages of all cuts, in the order of lang, term, source."""
    langs, sources, terms, runs, pairs = {}, {}, [], [], []
    for message in table.column("payload").to_pylist():
        header, own, (length, lang, hot), (source, doc, n) = _opened(message)
        terms += own
        lang = np.array([langs.setdefault(x, len(langs)) for x in header["langs"]], np.int64)[lang]
        runs.append(np.stack([length, lang, hot]))
        pairs.append(np.stack([np.array([sources.setdefault(x, len(sources)) for x in header["sources"]], np.int64)[source], doc, n]))
    (length, lang, hot), (source, doc, n) = np.concatenate(runs, axis=1), np.concatenate(pairs, axis=1)

    def ordered(names: dict) -> tuple[list[str], np.ndarray]:
        """The names in order, and the new number of each."""
        order = sorted(names)
        return order, np.argsort([names[x] for x in order])

    langs, new = ordered(langs)
    lang = new[lang]
    sources, new = ordered(sources)
    source = new[source]
    coded = pa.array(terms, pa.string()).dictionary_encode()
    by_name = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(by_name), np.int64)
    place[by_name] = np.arange(len(by_name))
    term = place[coded.indices.to_numpy(zero_copy_only=False)]
    names = coded.dictionary.take(pa.array(by_name))
    run = np.repeat((lang * len(names) + term) * 2 + hot, length) * len(sources) + source  # of a (lang, term, hot, source)
    order = np.lexsort((doc, run))
    run, doc, n = run[order], doc[order], n[order]
    begin = np.flatnonzero(_starts(run))
    n_docs, n = np.add.reduceat(_starts(run, doc).astype(np.int64), begin), np.add.reduceat(n, begin)
    key, source = np.divmod(run[begin], len(sources))
    lead = _starts(key)
    of, head = np.cumsum(lead) - 1, np.flatnonzero(lead)
    (lang, term), hot = np.divmod(key // 2, len(names)), key % 2 == 1
    return pa.table([
        pa.array(langs, pa.string()).take(pa.array(lang)), names.take(pa.array(term)), pa.array(sources, pa.string()).take(pa.array(source)), pa.array(n_docs), pa.array(n),
        pa.array(np.add.reduceat(n_docs, head)[of]), pa.array(np.add.reduceat(n, head)[of]), pa.array(lead), pa.array(hot),
    ], ["lang", "term", "source", "n_docs", "n", "lang_docs", "lang_n", "lead", "hot"])


def _changes(table: pa.Table, *names: str) -> np.ndarray:
    """Where a row differs from the one before it, the first row included."""
    out = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        out[1:] = False
        for name in names:
            column = table.column(name)
            out[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return out


def _whole_runs(batches, *names: str):
    """Tables of whole runs of rows that agree in the names, from sorted batches; the last run waits for what follows."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        starts = np.flatnonzero(_changes(table, *names))
        if held and all(held[0].column(n)[0].as_py() == table.column(n)[0].as_py() for n in names):
            starts = starts[1:]
            if not len(starts):
                held.append(table)
                continue
            held.append(table.slice(0, starts[0]))
        if held:
            yield pa.concat_tables(held)
        if len(starts) > 1:
            yield table.slice(starts[0], starts[-1] - starts[0])
        held = [table.slice(starts[-1])]
    if held:
        yield pa.concat_tables(held)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _pairs(batches):
    """From kept terms in order, with share p and absent: lang, source, item, value, the first line of the sum, for pairs of sources that share terms."""
    for table in _whole_runs(batches, "lang", "term"):
        table = table.combine_chunks()
        begin = np.flatnonzero(_changes(table, "lang", "term"))
        k = np.diff(np.append(begin, table.num_rows))
        lang, source = (pc.dictionary_encode(table.column(c).combine_chunks()) for c in ("lang", "source"))
        lang, source = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (lang, source))
        l, s = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source))
        p, z = (table.column(c).to_numpy() for c in ("p", "absent"))
        others, first = np.repeat(k, k), np.repeat(begin, k)  # each row meets all rows of its term
        upto = np.concatenate([[0], np.cumsum(others)])
        i = 0
        while i < len(p):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + PAIRS_AT_ONCE, "right")) - 1)
            a, b = np.repeat(np.arange(i, j), others[i:j]), ragged(first[i:j], others[i:j])
            a, b = a[a != b], b[a != b]
            value = _f(p[a], p[b]) - _f(p[a], z[b]) - _f(z[a], p[b]) + _f(z[a], z[b])
            n = len(source.dictionary)
            key, where = np.unique((l[a] * n + s[a]) * n + s[b], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, where, value)
            yield pa.record_batch([
                lang.dictionary.take(pa.array(key // (n * n))), source.dictionary.take(pa.array(key // n % n)), source.dictionary.take(pa.array(key % n)), pa.array(total),
            ], ["lang", "source", "item", "value"])
            i = j


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """docs: lang, source, doc (bigint), text. For each (lang, term, source) of a kept term: n, the term's count lang_n in the language, and lead, true in one row of a (lang, term)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(LEAST_BINS, -(-total // BIN_BYTES))
    messages = docs.mapInArrow(_cut(bins, max(LEAST_SALTS, bins // BINS_A_SALT), max(LEAST_HOT, least_docs)), MESSAGES)
    runs = written(messages.groupBy("bin").applyInArrow(_merged, RUNS), "term-runs")
    hot = runs.where("hot").select("lang", "term").distinct()
    by_term = Window.partitionBy("lang", "term")
    parts = runs.join(hot, ["lang", "term"], "left_semi").groupBy("lang", "term", "source").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    parts = parts.withColumns({"lang_docs": F.sum("n_docs").over(by_term), "lang_n": F.sum("n").over(by_term), "lead": F.row_number().over(by_term.orderBy("source")) == 1})
    columns = ["lang", "term", "source", "n", "lang_n", "lead", "lang_docs"]
    kept = runs.join(hot, ["lang", "term"], "left_anti").select(*columns).union(parts.select(*columns)).where(F.col("lang_docs") >= least_docs).drop("lang_docs")
    kept = written(kept, "kept-terms")
    forget(runs)
    return kept


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 1), wide(total + kept)) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank (see the module)."""
    number = F.col(id_col).cast("long") if dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint") else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
    slim = docs.select(whole(lang_col).alias("lang"), whole(source_col).alias("source"), F.coalesce(number, F.xxhash64(whole(text_col))).alias("doc"), whole(text_col).alias("text"))
    kept = kept_terms(slim, least_docs)

    # dimension tables: a row for each language, and for each source of one
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("lead").alias("kept"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = slim.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    absent = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    groups = written(groups.withColumn("absent", absent), "sources-of-languages")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    top = shares.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    top = top.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most_terms)

    wide = "decimal(38,0)"
    both = shares.select("lang", "term", "source", "p", "absent").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = both.mapInArrow(_pairs, "lang string, source string, item string, value bigint").select("lang", "source", "item", F.col("value").cast(wide).alias("value"))
    alike = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("m"), F.first("absent").alias("absent"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("z"))
    alone = alike.join(other, "lang").where("source <> item")
    gain = lambda p, q, a, b: (F.col("m") * (divergence(F.col(p), F.col(q)) - divergence(F.col(a), F.col(b))).cast("decimal(19,0)")).cast(wide).alias("value")
    mine = alone.select("lang", "source", "item", gain("p", "z", "absent", "z"))
    theirs = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), gain("z", "p", "z", "absent"))
    none = groups.join(other, "lang").where("source <> item")
    none = none.select("lang", "source", "item", F.coalesce(F.col("kept").cast("decimal(19,0)") * divergence(F.col("absent"), F.col("z")).cast("decimal(19,0)"), F.lit(0)).cast(wide).alias("value"))
    pairs = both.unionByName(mine).unionByName(theirs).unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(ranked))
    return pairs.unionByName(top).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
