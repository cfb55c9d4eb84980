"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, rare ones first; two lines of Jaccard
similarity 0.8 or more then share a word among the first fifth of either line (prefix filter). Pairs
that meet there must also agree in length, have enough words left behind the meeting point (positional
filter) and differ in few enough bits of a word bitmap, before their whole sets are compared.

All bounds are whole numbers: sets of n and m words with overlap o are similar if 9 o >= 4 (n + m).
Texts are not shuffled as such: lines travel as hashes and prefix words, and only lines that occur
again, lines that meet another one, and documents that may lose a line are moved as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import let, words
from costseries.session import landed

BUCKETS = 1 << 16  # of the rarity table, whose size doesn't depend on the corpus
MARKS = 1 << 23  # bits of a broadcast table that marks hashes (at most 131,072 rows); a full one costs time, never a line
TOP = 127  # the highest rarity class; the JVM keeps one object for each of such small numbers, so the constant table stays small
RANK_BIT = 53  # the key of a word has its rarity class from this bit on and its hash below

WORD = r"[^\x20\x09-\x0D]"
LINE = ["l1", "l2"]  # two independent hashes of a line
DOC = ["id", "h", "g"]  # a document: its id and two independent hashes of its text
PLACE = [*DOC, "pos"]  # and the position of a line in it
LONG = 90  # words from which on a line has two bitmap halves; together they fold into the single one of a shorter line
NEED = "((4 * (a.n + b.n) + 8) div 9)"
NEAR = f"""a.tok = b.tok AND a.l1 <> b.l1 AND a.n * 4 <= b.n * 5 AND b.n * 4 <= a.n * 5
    AND least(a.n - a.i, b.n - b.i) >= {NEED} AND a.n + b.n - 2 * {NEED} >=
    CASE WHEN a.n >= {LONG} AND b.n >= {LONG} THEN bit_count(a.bm ^ b.bm) + bit_count(a.bm2 ^ b.bm2)
    ELSE bit_count(a.bm ^ a.bm2 ^ b.bm ^ b.bm2) END"""


def join(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    return a.alias("a").join(b.alias("b"), F.expr(on), how)


def lines_of(docs: DataFrame) -> DataFrame:
    """All lines with a word: place, both hashes and the line itself. Rows equal in id and text are one document."""
    lines = docs.select(*DOC, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.where(F.col("line").rlike(WORD))
    return lines.select(*PLACE, "line", F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(1), "line").alias("l2"))


def text_hashes(body: Column) -> list[Column]:
    """128 bits that tell the texts of equal or missing ids apart."""
    return [F.xxhash64(body).alias("h"), F.xxhash64(F.lit(1), body).alias("g")]


def _cell(h: str) -> Column:
    return F.shiftright(F.col(h).bitwiseAND(F.lit(MARKS - 1)), 6).cast("int")


def _bit(h: str) -> Column:
    """Three bits of the cell, by parts of the hash that don't choose the cell."""
    places = [F.shiftright(F.col(h), at).bitwiseAND(F.lit(63)).cast("int") for at in (0, 24, 30)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def marks(rows: DataFrame, h: str = "l1") -> DataFrame:
    """Bit table of the hashes in column ``h``: a number of 64 bits per cell, ``MARKS`` / 64 cells at most."""
    return landed(rows.groupBy(_cell(h).alias("cell")).agg(F.bit_or(_bit(h)).alias("bits")), "marks")


def with_mark(rows: DataFrame, table: DataFrame, h: str = "l1") -> DataFrame:
    """Add ``mark``: false only if the hash is surely not in the table."""
    known = rows.join(F.broadcast(table), _cell(h) == F.col("cell"), "left")
    return known.withColumn("mark", F.coalesce(F.col("bits").bitwiseAND(_bit(h)) == _bit(h), F.lit(False))).drop("cell", "bits")


def bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(F.lit(BUCKETS - 1))


def rarity(docs: DataFrame) -> Column:
    """Class of each hash bucket by the number of its words in all texts: a constant array of ``BUCKETS`` numbers.

    Class 0 means a single occurrence. Rare words that share a bucket with frequent ones sort later than
    they could; any fixed order gives the same result.
    """
    found = docs.select(F.explode(words(F.col("text"))).alias("word"))
    counted = found.groupBy(bucket(F.xxhash64("word")).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    classes = ["0"] * BUCKETS
    for r in counted.where("n > 1").select("bucket", F.least(F.floor(4 * F.log2("n")), F.lit(TOP)).alias("c")).collect():
        classes[r["bucket"]] = str(r["c"])
    return F.split(F.lit(",".join(classes)), ",").cast("array<int>")


def keys(line: Column, classes: Column) -> Column:
    """Keys of the distinct words of a line, the rarest word first."""

    def low(word: Column) -> Column:
        return F.xxhash64(word).bitwiseAND(F.lit((1 << RANK_BIT) - 1))

    def key(h: Column) -> Column:
        return h.bitwiseOR(F.shiftleft(F.get(classes, bucket(h)).cast("long"), RANK_BIT))

    return F.sort_array(F.transform(F.array_distinct(F.transform(words(line), low)), key))


def prefixes(lines: DataFrame, classes: Column) -> DataFrame:
    """A row per line and prefix word: ``tok``, its place ``i``, the set size ``n`` and the bitmap halves ``bm`` and ``bm2`` of the line.

    Words that occur once in the corpus can't meet another line and are left out.
    """

    def flip(bits: Column, key: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int")))

    def bitmap(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), flip)

    known = lines.select("l1", keys(F.col("line"), classes).alias("keys"))
    n = F.size("keys")
    high = F.when(n >= LONG, bitmap(F.filter("keys", lambda k: k.bitwiseAND(F.lit(64)) != 0))).otherwise(F.lit(0).cast("long"))
    prefix = F.slice("keys", 1, n - F.ceil(n * 4 / 5).cast("int") + 1)
    known = known.select("l1", n.alias("n"), bitmap(F.col("keys")).alias("bm"), high.alias("bm2"), prefix.alias("prefix"))
    known = known.withColumn("bm", F.col("bm").bitwiseXOR(F.col("bm2")))
    rows = known.select("l1", "n", "bm", "bm2", F.posexplode_outer("prefix").alias("i", "key"))
    return rows.where(F.shiftright("key", RANK_BIT) > 0).select("l1", "n", "bm", "bm2", "i", F.hash("key").alias("tok"))


def similar(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The left lines of those pairs whose whole sets of words are similar."""
    left = join(pairs, lines, "a.l1 = b.l1 AND a.l2 = b.l2").select("a.*", "b.line")
    both = join(left, lines, "a.m1 = b.l1 AND a.m2 = b.l2").select("a.l1", "a.l2", F.col("a.line").alias("x"), F.col("b.line").alias("y"))
    sets = F.struct(*[F.array_distinct(words(F.col(c))).alias(c) for c in ("x", "y")])
    near = let(sets, lambda s: 9 * F.size(F.array_intersect(s["x"], s["y"])) >= 4 * (F.size(s["x"]) + F.size(s["y"])))
    return both.where(near).select(*LINE).distinct()


def later_matches(lines: DataFrame, again: DataFrame, classes: Column) -> DataFrame:
    """(l1, l2) of the distinct lines that are similar to an earlier one.

    Only meetings that pass all filters are kept, as rows per line and word, never as pairs. Most lines of a
    large group then fall to the first line of some shared word; only those left are compared with all.
    """
    told = with_mark(lines, again)
    often = told.where("mark").groupBy("l1", "line").agg(F.lit(1).alias("x"))
    rows = prefixes(told.where("not mark").select("l1", "line").unionAll(often.select("l1", "line")), classes)
    met = landed(join(rows, rows, NEAR, "left_semi").select("l1", "n", "bm", "bm2", "i", "tok").distinct(), "met")
    own = with_mark(lines, marks(met)).where("mark").groupBy(*LINE).agg(F.min(F.struct(*PLACE)).alias("first"), F.first("line").alias("line"))
    own = landed(join(own, met.select("l1").distinct(), "a.l1 = b.l1", "left_semi"), "lines")
    placed = landed(join(met, own.select(*LINE, "first"), "a.l1 = b.l1").select("a.*", "b.l2", "b.first"), "placed")
    pair = ["a.l1", "a.l2", F.col("b.l1").alias("m1"), F.col("b.l2").alias("m2")]
    earlier = f"{NEAR} AND b.first < a.first"
    heads = placed.groupBy("tok").agg(F.min(F.struct("first", *LINE, "n", "bm", "bm2", "i")).alias("head")).select("tok", "head.*")
    found = landed(similar(join(placed, heads, earlier).select(*pair).distinct(), own), "later")
    left = join(placed, found, "a.l1 = b.l1 AND a.l2 = b.l2", "left_anti")
    return found.unionAll(similar(join(left, placed, earlier).select(*pair).distinct(), own))


def dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents and columns, without the lines that match an earlier line; plus ``n_lines`` and ``n_removed``.

    Lines are ordered by id (null first), text hash and position. A line goes if its word set has a Jaccard
    similarity of 0.8 or more with that of any earlier line, removed or not. Lines without a word stay.
    A null text stays null, an empty one empty. Rows equal in id and text are one document and get the
    same result. Columns of the table can't clash: see ``row``, which holds them with the new text.
    """
    body = F.coalesce(docs[text], F.lit(""))
    lines = lines_of(docs.select(docs[doc].alias("id"), *text_hashes(body), body.alias("text")))
    firsts = landed(lines.groupBy(*LINE).agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    again = marks(firsts.where("n > 1"))
    removed = landed(later_matches(lines, again, rarity(docs.select(body.alias("text")))), "removed")

    # Only documents with a line that occurs again or goes can lose one.
    losing = with_mark(lines, marks(firsts.where("n > 1").select("l1").unionAll(removed.select("l1")))).where("mark")
    losing = marks(losing.select("h"), "h")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc].alias("id"), *text_hashes(body))
    whole = with_mark(whole, losing, "h")
    kept = join(firsts, removed, "a.l1 = b.l1 AND a.l2 = b.l2", "left_anti").select("a.first.*")
    kept = with_mark(kept, losing, "h").where("mark").groupBy(*DOC).agg(F.collect_list("pos").alias("at"))

    def split(row: Column) -> Column:
        return F.split(F.coalesce(row[text], F.lit("")), "\n")

    def cleaned(found: Column) -> Column:
        blank = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda k: ~F.get(found, k).rlike(WORD))
        stay = F.sort_array(F.concat(blank, F.coalesce(F.col("at"), F.array().cast("array<int>"))))
        new = F.array_join(F.transform(stay, lambda k: F.get(found, k)), "\n")
        return F.struct(new.alias("text"), F.size(found).cast("long").alias("n"), (F.size(found) - F.size(stay)).cast("long").alias("gone"))

    safe = whole.where("not mark").select("row", F.size(split(F.col("row"))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    found = join(whole.where("mark"), kept, "a.id <=> b.id AND a.h = b.h AND a.g = b.g", "left").select("a.row", "b.at")
    done = found.select("row", let(split(F.col("row")), cleaned).alias("new"))
    changed = F.when(F.col("row")[text].isNotNull(), F.col("new.text"))
    done = done.select(F.col("row").withField(text, changed).alias("row"), F.col("new.n").alias("n_lines"), F.col("new.gone").alias("n_removed"))
    return safe.unionAll(done)


def sql() -> str:
    """The same as DuckDB SQL over ``documents`` with distinct ids."""
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
w AS (SELECT doc_id, pos, line, list_sort(list_distinct(regexp_extract_all(line, '{word}'))) AS ws FROM l),
s AS (SELECT ws, min({{'d': doc_id, 'p': pos}}) AS f FROM w WHERE len(ws) > 0 GROUP BY ws),
t AS (SELECT row_number() OVER () AS id, ws, f, len(ws) AS n FROM s),
k AS (SELECT id, n, unnest(ws) AS tok FROM t),
df AS (SELECT tok, count(*) AS c FROM k GROUP BY tok),
r AS (SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY c, tok) AS i FROM k JOIN df USING (tok)),
p AS (SELECT * FROM r WHERE i <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b USING (tok) WHERE a.id <> b.id AND a.n * 4 <= b.n * 5 AND b.n * 4 <= a.n * 5),
m AS (SELECT DISTINCT x FROM c JOIN t a ON a.id = x JOIN t b ON b.id = y
      WHERE b.f < a.f AND 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.n + b.n)),
keep AS (SELECT f.d AS doc_id, f.p AS pos FROM t WHERE id NOT IN (SELECT x FROM m)),
stay AS (SELECT w.doc_id, w.pos, w.line FROM w LEFT JOIN keep k ON k.doc_id = w.doc_id AND k.pos = w.pos WHERE len(ws) = 0 OR k.pos IS NOT NULL),
new AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS body, count(*) AS n FROM stay GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(body, '') END AS text, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_removed
FROM d LEFT JOIN new USING (doc_id)"""
