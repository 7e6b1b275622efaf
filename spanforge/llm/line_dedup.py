"""Fuzzy line dedup by MinHash over character shingles: banding, exact Jaccard verification, distributed union-find.

DataFrame and SQL functions only. Lines are compared as ``lower(trim(line))``; every line that is not empty takes part. Equal lines are
one node, named by their 64-bit hash. A line's shingles are the distinct windows of ``SHINGLE`` UTF-16 units (characters, but for
those beyond U+FFFF, which are two); a shorter line is one shingle, so it can only equal others. The signature is one-permutation
MinHash: a shingle's hash names one of ``BINS`` bins, a bin keeps the least value, an empty bin borrows from the next.
``BANDS`` bands of ``ROWS`` minima give the band keys. Then:

1. Lines that share a key are compared with the first of them (a star) by the exact Jaccard similarity of their shingle sets; links of at least
   ``PERCENT`` / 100 give components.
2. Keys whose lines are still in several components are searched to the end: all their pairs of different components are
   compared in blocks of ``BLOCK`` lines, in the condition of a join, so only links come out. So each pair
   that shares a key is verified or already joined.
3. One line per component stays: the one at the smallest position (doc_id, line_no).

Scale: shingles never cross the network; a line's minima do, once, combined by line first, so a hot line is one row a task. Keys are
counted with map-side combination, and joins on keys or hashes are plain ones that Spark splits when skewed. Expected recall of a pair at
similarity s, by the odds of sharing a key: 1 - (1 - s**3)**5, 97.2 % at 0.8, 99.2 % at 0.85, 99.9 % at 0.9. One character that differs inside a line of n
shingles leaves (n - 10) / (n + 10): 0.8 needs n >= 90, so inner edits of shorter lines are not caught.

Defined results: null text has no lines; empty text has one empty line; lines empty after trimming always stay; rows with a null
doc_id are not compared and stay whole; rows that repeat a doc_id are told apart by their text, and equal rows do not remove each
other; an empty table gives an empty result; other columns are returned as they are (one named ``lines_removed`` comes
before the result's own). Lines are equal by 128 bits of hash, those of a component by 64.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, materialize
from .graph import components

SHINGLE, BANDS, ROWS, PERCENT = 10, 5, 3, 80
BINS = BANDS * ROWS
#: Expected number of a line's shingles in a bin that are looked at for its minimum; a bin without any borrows.
DEPTH = 4
#: Stars around other lines of a key, before blocks of so many lines are compared pair by pair; longs of a line's bit map.
STARS, BLOCK, LONGS = 3, 512, 64


def _norm(line: Column) -> Column:
    return F.lower(F.trim(line))


def _place(doc_id: Column, line_no: Column) -> Column:
    """A position as one ordered number, so that its least is combined before the shuffle."""
    return doc_id.cast("decimal(20,0)") * F.lit(2**31).cast("decimal(11,0)") + line_no


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, body (hash of the text), line_no, norm, h1, h2 of the lines that are not empty."""
    at = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    at = at.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    at = at.select("doc_id", "body", "line_no", _norm(F.col("line")).alias("norm")).filter("norm <> ''")
    return at.select("*", F.xxhash64("norm").alias("h1"), F.xxhash64("norm", F.lit(17)).alias("h2"))


def _units(norm: Column) -> Column:
    return F.encode(norm, "UTF-16BE")


def _starts(units: Column) -> Column:
    """Where shingles start in the units' bytes; a shorter line is one shingle."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(units) - (2 * SHINGLE - 1), F.lit(1)), F.lit(2))


def _shingle(units: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(units, start, F.lit(2 * SHINGLE)))


def signatures(at: DataFrame) -> DataFrame:
    """node, keys: the band keys of each distinct line (a node is the line's hash) longer than a shingle. Shingles are hashed where the line is read, in one projection, and only those that can be
    a bin's minimum get to the aggregation; what is shuffled is one row of minima for a line."""
    wide = at.filter(F.char_length("norm") > SHINGLE).select("h1", "h2", _units(F.col("norm")).alias("units"))
    count = F.octet_length("units") / 2 - (SHINGLE - 1)
    limit = F.least(F.lit(float(2**31)), F.lit(float(2**31 * DEPTH * BINS)) / count).cast("long")
    hashed = wide.select("h1", "h2", "units", limit.alias("limit"), F.explode(_starts(F.col("units"))).alias("start")).select("h1", "h2", "limit", _shingle(F.col("units"), F.col("start")).alias("h"))
    value = F.col("h").bitwiseAND(F.lit(2**31 - 1))
    hashed = hashed.filter(value < F.col("limit")).select("h1", "h2", value.cast("int").alias("v"), (F.shiftrightunsigned("h", 33) % BINS).cast("int").alias("bin"))
    none = 2**31 - 1
    minima = hashed.groupBy("h1", "h2").agg(*[F.min(F.when(F.col("bin") == i, F.col("v")).otherwise(none)).alias(f"m{i}") for i in range(BINS)])
    minima = minima.select("h1", *[F.when(F.col(f"m{i}") < none, F.col(f"m{i}")).alias(f"m{i}") for i in range(BINS)])
    step = 1
    while step < BINS:  # an empty bin borrows from the next one that isn't
        minima = minima.select("h1", *[F.coalesce(f"m{i}", f"m{(i + step) % BINS}").alias(f"m{i}") for i in range(BINS)])
        step *= 2
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)]
    return minima.select(F.col("h1").alias("node"), F.array(*keys).alias("keys"))


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, body, line_no) of every line that another line of its component replaces."""
    at = materialize(lines(docs), "lines")
    signed = materialize(signatures(at), "line_signatures")

    # keys that several lines share, and their lines; the first of a key is its star's head
    band = signed.select("node", F.posexplode("keys").alias("band", "key"))
    shared = band.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last").select("key", "head")
    member = materialize(band.join(shared, "key"), "line_buckets")
    discard(signed)
    wanted = member.select("node").distinct()
    texts = at.filter(F.char_length("norm") > SHINGLE).select(F.col("h1").alias("node"), "norm").join(wanted, "node", "left_semi")
    texts = materialize(texts.dropDuplicates(["node"]), "line_texts")

    comp = _linked(member, texts, percent)
    for done in (member, texts):
        discard(done)

    # the first position of each component, and of each group of equal lines outside of any
    rows = at.select("doc_id", "body", "line_no", "h1", "h2").join(comp.withColumnRenamed("node", "h1"), "h1", "left")
    rows = rows.select("doc_id", "body", "line_no", F.coalesce("component", "h1").alias("g1"), F.when(F.col("component").isNull(), F.col("h2")).otherwise(0).alias("g2"))
    place = _place(F.col("doc_id"), F.col("line_no"))
    first = rows.select("g1", "g2", place.alias("place")).groupBy("g1", "g2").agg(F.min("place").alias("kept"), F.max("place").alias("last")).filter("kept < last").drop("last")
    gone = materialize(rows.join(first, ["g1", "g2"]).filter(place > F.col("kept")).select("doc_id", "body", "line_no"), "line_gone")
    for done in (at, comp):
        discard(done)
    return gone


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's variable isn't replaced by its expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _set(norm: Column) -> Column:
    """Distinct shingle hashes of a line."""
    return F.array_distinct(_let(_units(norm), lambda units: F.transform(_starts(units), lambda i: _shingle(units, i))))


def _alike(percent: int) -> Column:
    """Whether the sets x and y are similar enough: J >= p is (100 + p) * common >= p * (|x| + |y|)."""
    return F.size(F.array_intersect("x", "y")) * (100 + percent) >= percent * (F.size("x") + F.size("y"))


def _star_links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough; texts: node, norm. Texts are joined and their sets built after that, once (a row's number keeps
    the filter behind them)."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("norm").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("norm").alias("y")), "b")
    both = both.select("a", "b", _set(F.col("x")).alias("x"), _set(F.col("y")).alias("y"), F.monotonically_increasing_id().alias("row"))
    return materialize(both.filter((F.col("row") >= 0) & _alike(percent)).select("a", "b"), "line_links")


def _mixed(member: DataFrame, comp: DataFrame) -> DataFrame:
    """key, band, node, component, size of the keys of three or more lines in several components. (A pair is a line and its key's
    first, which is known.)"""
    rows = member.select("key", "band", "node").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keys = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"))
    return materialize(rows.join(keys.filter("lo <> hi and size > 2").select("key", "size"), "key"), "line_mixed")


def _mapped(sets: DataFrame) -> DataFrame:
    """``sets`` and b0 ... : a map of 64 * ``LONGS`` bits, one set where a shingle's hash points. Bits that differ between two lines are at most as
    many as shingles that differ."""
    at = sets.select("node", "set").repartition("node").select("node", F.explode("set").alias("h"))
    at = at.select("node", (F.shiftrightunsigned("h", 40) % LONGS).cast("int").alias("long"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    at = at.groupBy("node", "long").agg(F.bit_or("bit").alias("bits"))
    return sets.join(at.groupBy("node").agg(*[F.max(F.when(F.col("long") == k, F.col("bits"))).alias(f"b{k}") for k in range(LONGS)]), "node")


def _linked(member: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(node, component) from the verified links of all pairs that share a key: a star around a key's first line, stars around ``STARS`` other lines
    of the keys that are still in several components, and what is left then is compared in blocks."""
    pairs = member.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = _star_links(pairs, texts, percent)
    comp = materialize(components(links), "line_components")
    mixed = _mixed(member, comp)
    own = mixed.groupBy("node").agg(*[F.max(F.when(F.col("band") == b, F.col("key"))).alias(f"k{b}") for b in range(BANDS)])
    sets = materialize(texts.join(own, "node").select("node", _set(F.col("norm")).alias("set"), *[f"k{b}" for b in range(BANDS)]), "line_sets")
    sets, plain = materialize(_mapped(sets), "line_sets"), sets
    discard(plain)
    for step in (_pivots, _block_links):
        if mixed.isEmpty():
            break
        more = _star_links(_pivots(mixed), texts, percent) if step is _pivots else _block_links(mixed, sets, percent)
        if not more.isEmpty():
            before, both = (comp, links, mixed), links.unionByName(more)
            comp = materialize(components(both), "line_components")
            links, mixed = materialize(both, "line_links"), _mixed(mixed, comp)
            for done in before:
                discard(done)
        discard(more)
    for done in (links, mixed, sets):
        discard(done)
    return comp


def _pivots(mixed: DataFrame) -> DataFrame:
    """(a, b): each line of a key with ``STARS`` others, if they are in different components."""
    turn = [F.min(F.struct(F.xxhash64("node", F.lit(t)).alias("turn"), F.col("node").alias("b"), F.col("component").alias("other"))) for t in range(STARS)]
    pivot = mixed.groupBy("key").agg(F.array(*turn).alias("p")).select("key", F.explode("p").alias("p")).select("key", "p.b", "p.other")
    return mixed.join(pivot, "key").filter("component <> other").select(F.col("node").alias("a"), "b").distinct()


def _block_links(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): similar lines of different components that share a key. Every such pair is compared once, at its first shared key, in the
    condition of a join of blocks: by the bit maps, which bound the difference from below, then by the sets. Only links come
    out. Both sides are one shuffle, read twice: the condition tells which side of a block a row is on."""
    rows = mixed.join(sets, "node").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("long")).withColumn("mine", F.pmod(F.xxhash64("node", "key"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other"), "n": F.size("set")})
    maps = [F.coalesce(f"b{k}", F.lit(0)).alias(f"b{k}") for k in range(LONGS)]
    rows = rows.select("key", "i", "j", "mine", "band", "node", "component", "set", "n", *[f"k{b}" for b in range(BANDS)], *maps)
    left, right = rows.alias("l"), rows.alias("r")
    same = F.expr("l.key = r.key and l.i = r.i and l.j = r.j and l.component <> r.component and l.mine - r.mine = l.i - r.j and (l.i < r.j or l.node < r.node)")
    first = F.expr(" and ".join(f"(l.band + r.band <= {2 * b} or l.k{b} is null or r.k{b} is null or l.k{b} <> r.k{b})" for b in range(BANDS)))
    differ = " + ".join(f"bit_count(l.b{k} ^ r.b{k})" for k in range(LONGS))  # at J >= p, at most (1 - p) / (1 + p) of both sizes
    bound = F.expr(f"({differ}) * {100 + percent} <= {100 - percent} * (l.n + r.n)")
    exact = F.size(F.array_intersect("l.set", "r.set")) * (100 + percent) >= percent * (F.col("l.n") + F.col("r.n"))
    both = left.join(right, same & first & bound & exact)
    return materialize(both.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")), "line_links")


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All columns of ``docs`` with ``text`` rebuilt from the lines that stay, and ``lines_removed`` (line numbers)."""
    gone = removed_lines(docs, percent).groupBy(F.col("doc_id").alias("_gone_id"), F.col("body").alias("_gone_body")).agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    keep = [F.col(f"d.`{c}`") for c in docs.columns]
    out = docs.alias("d").join(gone, (F.col("d.doc_id").cast("long") == F.col("_gone_id")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("_gone_body")), "left")
    text = F.col("d.text").cast("string")
    rebuilt = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n"))
    keep = [rebuilt.alias("text") if c == "text" else k for c, k in zip(docs.columns, keep, strict=True)]
    return out.select(*keep, F.coalesce("_gone", F.array().cast("array<int>")).alias("lines_removed"))


def op10_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))
    out = dedup(docs)
    return out.select("doc_id", "n_lines", F.size("lines_removed").cast("long").alias("n_removed"), F.array_join("lines_removed", ",").alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op10_line_minhash": op10_line_minhash}
ORACLE: dict[str, str] = {}
