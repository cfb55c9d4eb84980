"""Quality of texts by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import let, words
from costseries.session import landed

WINDOW = 5
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROUNDS = 40
WEIGHT = 0.02  # of the prior belief about each rule, as a share of all documents
PRIOR = 0.85  # belief in a good document before any vote
# Prior chances of a vote (bad, none, good) on a good and on a bad document.
ON_GOOD, ON_BAD = (0.02, 0.18, 0.8), (0.3, 0.2, 0.5)

# Votes as SQL over the counts: when it is bad, when it is good; neither is an abstention.
RULES = {
    "symbols": ("n_symbols * 10 > n_words", "n_symbols * 50 <= n_words"),
    "symbol_share": ("n_symbols * 20 > word_chars", "n_symbols * 200 <= word_chars"),
    "dirty_words": ("n_dirty * 5 > n_words", "n_dirty * 50 <= n_words"),
    "lines": ("n_dup_lines > 1 AND n_dup_lines * 10 > n_lines * 3", "n_lines > 1 AND n_dup_lines = 0"),
    "repeats": ("n_repeat_words * 5 > n_words", "n_repeat_words * 20 <= n_words"),
    "word_length": ("word_chars < n_words * 3 OR word_chars > n_words * 11", "word_chars * 2 >= n_words * 7 AND word_chars <= n_words * 9"),
    "shouts": ("n_shouts * 10 > n_words", "n_shouts * 50 <= n_words"),
    "capitals": ("n_capitals * 10 > word_chars * 3", "n_capitals * 10 <= word_chars"),
    "variety": ("n_words >= 50 AND n_distinct * 5 < n_words", "n_distinct * 3 >= n_words"),
    "length": ("n_words < 20", "n_words >= 40"),
}


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def repeated_words(found: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found at least twice, the first one included.

    Windows are compared by a 64-bit hash. Only texts with a repeated window sort their windows.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, k: F.least(F.lit(size), F.coalesce(F.get(starts, k + 1) - s, F.lit(size))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def among(ranked: Column) -> Column:
        def again(e, k):
            return (F.get(ranked, k - 1)["h"] == e["h"]) | (F.get(ranked, k + 1)["h"] == e["h"])

        twice = F.filter(ranked, lambda e, k: F.coalesce(again(e, k), F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    def of(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ranked, among))

    at = F.sequence(F.lit(0), F.size(found) - size)
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(size)]))
    return F.when(F.size(found) <= size, F.lit(0)).otherwise(let(windows, of))


def counts(text: Column) -> Column:
    """All counts of a text as a struct of longs; a null text has none of anything."""
    body = F.coalesce(text, F.lit(""))
    blank = " \t\n\x0b\x0c\r"

    def build(found: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda x: F.length(_without(x, blank)) > 0)
        named = {
            "n_words": F.size(found),
            "word_chars": F.length(_without(body, blank)),
            "n_symbols": F.length(body) - F.length(_without(body, SYMBOLS)),
            "n_repeat_words": repeated_words(found),
            "n_distinct": F.size(F.array_distinct(found)),
            "n_shouts": F.length(body) - F.length(_without(body, "!")),
            "n_capitals": F.length(body) - F.length(_without(body, CAPITALS)),
            "n_dirty": F.when(
                F.length(_without(body, SYMBOLS)) < F.length(body), F.size(F.filter(found, lambda w: F.length(_without(w, SYMBOLS)) < F.length(w)))
            ).otherwise(F.lit(0)),
            "lines": let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))),
        }
        return F.struct(*[c.alias(n) for n, c in named.items()])

    return let(words(body), build)


NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_shouts", "n_capitals", "n_dirty"]


def vote(rule: str) -> Column:
    bad, good = RULES[rule]
    return F.when(F.expr(bad), 0).when(F.expr(good), 2).otherwise(1)


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + value(x))


def log_odds(votes: Column, model: Column) -> Column:
    """Logarithm of the odds for good, given votes (0 bad, 1 none, 2 good) and the chances of each."""
    odds = F.log(model["prior"] / (1 - model["prior"]))
    for k in range(len(RULES)):
        at = votes[k] + 3 * k
        odds = odds + F.log(model["good"][at] / model["bad"][at])
    return odds


def posterior(votes: Column, model: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds(votes, model)))


def estimate(votes: DataFrame) -> DataFrame:
    """One row: the prior and each rule's chances of every vote on good and on bad documents.

    ``votes`` has an array column ``votes``, a row per document. Expectation-maximisation runs over the distinct vote
    patterns, at most 3 ** rules of them, which meet in one row. It starts from the number of bad
    votes and keeps a prior belief that weighs a fixed share of the documents.
    """
    patterns = votes.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("rows"))

    def maximise(weighed: Column) -> Column:
        """``weighed`` rows hold votes, the weight of good and the weight of bad."""
        total = _sum(weighed, lambda r: r["g"] + r["b"])

        def of(total: Column) -> Column:
            def side(field: str, prior: tuple) -> Column:
                def chances(all_: Column) -> Column:
                    def chance(k: int, v: int) -> Column:
                        hits = _sum(weighed, lambda r: F.when(r["votes"][k] == v, r[field]).otherwise(0.0))
                        return (hits + prior[v] * WEIGHT * total) / (all_ + WEIGHT * total)

                    return F.array(*[chance(k, v) for k in range(len(RULES)) for v in range(3)])

                return let(_sum(weighed, lambda r: r[field]), chances)

            good = (_sum(weighed, lambda r: r["g"]) + PRIOR * WEIGHT * total) / (total * (1 + WEIGHT))
            return F.struct(good.alias("prior"), side("g", ON_GOOD).alias("good"), side("b", ON_BAD).alias("bad"))

        return let(total, of)

    def weigh(data: Column, share) -> Column:
        return F.transform(
            data,
            lambda r: let(share(r), lambda p: F.struct(r["votes"].alias("votes"), (r["n"] * p).alias("g"), (r["n"] * (1 - p)).alias("b"))),
        )

    def start(row: Column) -> Column:
        bad = F.size(F.filter(row["votes"], lambda v: v == 0))
        return F.when(bad == 0, F.lit(0.95)).when(bad == 1, F.lit(0.3)).otherwise(F.lit(0.05))

    def fit(data: Column) -> Column:
        first = let(weigh(data, start), maximise)
        step = lambda model, _: let(weigh(data, lambda r: posterior(r["votes"], model)), maximise)
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, step)

    return rows.select(F.when(F.size("rows") > 0, let(F.col("rows"), fit)).alias("model"))


def constant(model: DataFrame) -> Column:
    """The one row of ``estimate`` (61 numbers, whatever the corpus) as a constant, so that no plan repeats the estimation."""
    row = model.first()["model"]
    if row is None:
        return F.lit(None).cast(model.schema["model"].dataType)
    chances = [F.array(*[F.lit(x) for x in row[side]]).alias(side) for side in ("good", "bad")]
    return F.struct(F.lit(row["prior"]).alias("prior"), *chances)


def rate(docs: DataFrame, doc: str = "doc_id", text: str = "text", rows: bool = False) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``posterior`` and ``kept``; with ``rows``, the whole row as ``row``.

    A document is kept if it passes the base rule and its posterior probability of being good is at
    least one half. A null or empty text has no words and fails. Repeated rows count and are judged
    each on its own; an empty table gives an empty result; columns of the table can't clash.
    """
    whole = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if rows else []
    measured = docs.select(*whole, docs[doc].alias("id"), counts(docs[text]).alias("c"))
    measured = measured.withColumn("n_lines", F.col("c.lines.n")).withColumn("n_dup_lines", F.col("c.lines.n") - F.col("c.lines.d"))
    plain = [F.col(n if n in ("n_lines", "n_dup_lines") else f"c.{n}").cast("long").alias(n) for n in NUMBERS]
    measured = landed(measured.select(*["row"] * rows, "id", *plain), "quality")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    voted = measured.withColumn("votes", F.array(*[vote(r) for r in RULES]))
    judged = voted.withColumn("posterior", posterior(F.col("votes"), constant(estimate(voted.select("votes")))))
    return judged.select(
        *["row"] * rows, F.col("id").alias(doc), *NUMBERS, failed.alias("base_failed"), F.round("posterior", 6).alias("posterior"),
        (~failed & (F.round("posterior", 6) >= 0.5)).alias("kept"),
    )


def keep_good(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Nulls, empty texts, repeated rows and empty tables as in ``rate``: a null or empty text goes, of repeated rows
    all stay or all go. Ties don't arise, as every row is judged on its own.
    """
    return rate(docs, doc, text, rows=True).where("kept").select("row.*")


def sql() -> str:
    """The same as DuckDB SQL over ``documents``."""
    names = list(RULES)
    blank = "[^\\x20\\x09-\\x0D]"
    params = [f"{s}{k}{v}" for s in "gb" for k in range(len(names)) for v in range(3)]

    def new(p: str) -> str:
        s, k, v = p[0], int(p[1:-1]), int(p[-1])
        prior, w = (ON_GOOD, "w * p") if s == "g" else (ON_BAD, "w * (1 - p)")
        return f"(sum(CASE WHEN v{k} = {v} THEN {w} ELSE 0.0 END) + {prior[v]} * {WEIGHT} * sum(w)) / (sum({w}) + {WEIGHT} * sum(w)) AS {p}"

    def odds() -> str:
        parts = [f"ln(CASE v{k} WHEN 0 THEN g{k}0 / b{k}0 WHEN 1 THEN g{k}1 / b{k}1 ELSE g{k}2 / b{k}2 END)" for k in range(len(names))]
        return "ln(prior / (1 - prior)) + " + " + ".join(parts)

    prior = f"(sum(w * p) + {PRIOR} * {WEIGHT} * sum(w)) / (sum(w) * (1 + {WEIGHT})) AS prior"
    votes = ", ".join(f"CASE WHEN {b} THEN 0 WHEN {g} THEN 2 ELSE 1 END AS v{k}" for k, (b, g) in enumerate(RULES.values()))
    keys = ", ".join(f"v{k}" for k in range(len(names)))
    bad = " + ".join(f"(v{k} = 0)::INT" for k in range(len(names)))
    made = ", ".join([prior, *map(new, params)])
    minus = lambda letters: "length(body) - length(translate(body, '" + letters + "', ''))"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT r, doc_id, body, regexp_extract_all(body, '{blank}+') AS ws FROM d),
l AS (SELECT r, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{blank}')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {WINDOW}),
g5 AS (SELECT r, i, ws[i:i + {WINDOW - 1}] AS five FROM g),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM g5) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) AS t(k) GROUP BY r),
c AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    ({minus(SYMBOLS)})::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines, len(list_distinct(ws))::BIGINT AS n_distinct,
    ({minus("!")})::BIGINT AS n_shouts, ({minus(CAPITALS)})::BIGINT AS n_capitals,
    len(list_filter(ws, lambda x: regexp_matches(x, '[{SYMBOLS}]')))::BIGINT AS n_dirty
  FROM w JOIN l USING (r) LEFT JOIN rep USING (r)),
v AS (SELECT *, {votes} FROM c),
pat AS (SELECT {keys}, count(*)::DOUBLE AS w FROM v GROUP BY ALL),
em AS (
  SELECT 0 AS it, {made} FROM (SELECT *, CASE {bad} WHEN 0 THEN 0.95 WHEN 1 THEN 0.3 ELSE 0.05 END AS p FROM pat)
  UNION ALL
  SELECT it + 1, {made.replace(" AS prior", "").replace(" AS ", " AS n_")}
  FROM (SELECT *, 1 / (1 + exp(-({odds()}))) AS p FROM em, pat WHERE it < {ROUNDS}) GROUP BY it),
j AS (SELECT v.*, round(1 / (1 + exp(-({odds()}))), 6) AS posterior FROM v, em WHERE it = {ROUNDS})
SELECT doc_id, {", ".join(NUMBERS)}, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed, posterior,
  NOT (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AND posterior >= 0.5 AS kept
FROM j"""
