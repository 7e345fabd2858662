"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Each rule is a badness measure of a document, cut into CELLS steps; a cutoff rejects the documents at or above it. The
labelled documents are the holdout. In each stratum (the language) a cutoff may be used only if an exact binomial test
shows that it rejects at most a share RISK / rules of the documents labelled good: with k false rejections among n,
P(Binomial(n, share) <= k) must be at most CONFIDENCE / (rules * strata) (Bonferroni over rules and strata). Within a
rule the cutoffs are tested from the most lenient on; as k only grows, the first failure ends the sequence, so no
further correction is due. Of the cutoffs that pass, the one with the most bad documents rejected, less COST times the
good ones, is taken, and none if that is not above zero. A stratum with too few labels to pass anything rejects nothing.

Null texts have no words and fail the base rule; a null language is a stratum of its own. Labels that occur twice for a
document count as good if any of them does; repeated documents are judged each. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_SQL, written

RISK, CONFIDENCE, CELLS, COST = 0.02, 0.05, 200, 4
#: Names of the rules; each is a column of measure().
RULES = ("symbols", "upper", "shouts", "dup_lines", "repeats")


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Base counts and the cells of the rules for each document."""
    given = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"), docs[stratum].cast("string").alias("stratum"))
    cut = given.select(
        "doc_id",
        "stratum",
        F.expr(f"filter(split(text, '{SPACE_SQL}+'), w -> w != '')").alias("words"),
        F.expr(r"length(translate(text, ' \t\n\u000b\u000c\r', ''))").cast("long").alias("word_chars"),
        F.expr("length(text) - length(translate(text, '#*$%&|<>', ''))").cast("long").alias("n_symbols"),
        F.expr("length(text) - length(translate(text, '!', ''))").cast("long").alias("n_shouts"),
        F.expr(r"regexp_count(text, '\\p{Lu}')").cast("long").alias("n_upper"),
        F.expr(r"filter(split(text, '\n'), s -> length(translate(s, ' \t\u000b\u000c\r', '')) > 0)").alias("lines"),
    )
    hashed = cut.select(
        "*",
        F.expr("size(words)").cast("long").alias("n_words"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr("size(lines)").alias("n_lines"),
        F.expr("CASE WHEN size(words) >= 8 THEN transform(sequence(1, size(words) - 7), i -> xxhash64(slice(words, i, 8))) ELSE cast(array() as array<bigint>) END").alias("windows"),
    ).drop("words", "lines")
    # only documents that hold a window twice need their windows in order
    ordered = hashed.withColumn(
        "ordered",
        F.expr("CASE WHEN size(array_distinct(windows)) < size(windows) THEN array_sort(transform(windows, (h, i) -> struct(h, i))) ELSE NULL END"),
    ).drop("windows")
    starts = ordered.withColumn(
        "starts",
        F.expr("array_sort(transform(filter(ordered, (x, i) -> get(ordered, i - 1).h <=> x.h OR get(ordered, i + 1).h <=> x.h), x -> x.i))"),
    ).drop("ordered")
    counted = starts.withColumn(
        "n_repeat_words",
        F.expr("coalesce(aggregate(transform(starts, (p, i) -> coalesce(least(8, get(starts, i + 1) - p), 8)), 0L, (a, x) -> a + x), 0L)"),
    )
    share = lambda top, bottom, times: F.least(F.lit(CELLS), F.floor(F.lit(times) * F.col(top) / F.greatest(F.col(bottom), F.lit(1)))).cast("int")
    return counted.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars", 4 * CELLS).alias("symbols"),
        share("n_upper", "word_chars", CELLS).alias("upper"),
        share("n_shouts", "n_words", CELLS).alias("shouts"),
        share("n_dup_lines", "n_lines", CELLS).alias("dup_lines"),
        share("n_repeat_words", "n_words", CELLS).alias("repeats"),
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
    )


def log_factorial(x: str) -> str:
    """SQL for ln(x!), by Stirling's series at x + 8 less the logarithms of the steps."""
    z = f"(double({x}) + 8)"
    steps = " + ".join(f"ln(double({x}) + {i})" for i in range(1, 9))
    return f"({z} * ln({z}) - {z} + 0.5 * ln(2 * pi() * {z}) + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3)) + 1 / (1260 * pow({z}, 5)) - ({steps}))"


def most_false(n: str, share: float, log_level: str) -> F.Column:
    """The largest k with P(Binomial(n, share) <= k) at most exp(log_level), -1 if there is none.

    Terms further than 40 standard deviations below the mean, together under exp(-700), are left out of the sum.
    """
    low = f"greatest(0L, bigint(floor({n} * {share!r} - 40 * sqrt({n} * {share!r}))))"
    first = f"({log_factorial(n)} - {log_factorial(low)} - {log_factorial(f'({n} - {low})')} + {low} * ln({share!r}) + ({n} - {low}) * ln(1 - {share!r}))"
    add = "greatest(a.total, a.term) + ln(1 + exp(-abs(a.total - a.term)))"
    step = (
        f"(a, i) -> named_struct('term', a.term + ln(greatest({n} - i, 1L) / double(i + 1)) + ln({share!r} / (1 - {share!r})), 'total', {add}, "
        f"'k', CASE WHEN {add} <= {log_level} THEN i ELSE a.k END)"
    )
    return F.expr(f"aggregate(sequence({low}, bigint(floor({n} * {share!r}))), named_struct('term', {first}, 'total', double(-1e300), 'k', -1L), {step}, a -> a.k)")


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """stratum, rule and cutoff (least cell that is rejected), with the counts that back it."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("good"))
    held = measured.join(marked, "doc_id").where(~F.col("base_failed"))
    per_rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("cell")) for r in RULES])).alias("x")
    counts = (
        held.select("stratum", "good", per_rule)
        .groupBy("stratum", "x.rule", "x.cell")
        .agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("good") == 0, 1).otherwise(0)).alias("bad"))
    )
    # from here on a row for each stratum, rule and cell
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("stratum", "rule")
    summed = counts.select("stratum", "rule", "cell", F.sum("good").over(above).alias("k"), F.sum("bad").over(above).alias("caught"), F.sum("good").over(whole).alias("n"))
    strata = counts.select("stratum").distinct().agg(F.count("*").alias("strata"))
    level = f"ln({confidence!r} / ({len(RULES)} * strata))"
    limits = summed.select("stratum", "rule", "n").distinct().join(F.broadcast(strata)).withColumn("level", F.expr(level))
    limits = limits.withColumn("most", most_false("n", risk / len(RULES), "level")).select("stratum", "rule", "most")
    same = [F.col("s.stratum").eqNullSafe(F.col("l.stratum")), F.col("s.rule") == F.col("l.rule")]
    passed = summed.alias("s").join(limits.alias("l"), same).select("s.*", "l.most").where((F.col("k") <= F.col("most")) & (F.col("cell") > 0) & (F.col("caught") > COST * F.col("k")))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc(F.col("caught") - COST * F.col("k")), F.desc("cell"))
    return passed.withColumn("at", F.row_number().over(best)).where("at = 1").select("stratum", "rule", F.col("cell").alias("cutoff"), "k", "n", "caught")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """The base counts, base_failed and kept for each document, with the rules that rejected it."""
    measured = written(measure(docs), "quality")
    found = cutoffs(measured, labels, risk, confidence)
    limits = written(found.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"most_{r}") for r in RULES]), "quality-cutoffs")
    # as many rows as strata; Spark knows the written table's size and broadcasts it only under its threshold
    both = measured.alias("m").join(limits.alias("l"), F.col("m.stratum").eqNullSafe(F.col("l.stratum")), "left")
    hit = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"m.{r}") >= F.col(f"l.most_{r}"), F.lit(r)) for r in RULES])), ",")
    return both.select("m.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "m.base_failed", (~F.col("m.base_failed") & (hit == "")).alias("kept"), hit.alias("rejected_by"))


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    measures = {
        "symbols": f"{4 * CELLS} * n_symbols / greatest(word_chars, 1)", "upper": f"{CELLS} * n_upper / greatest(word_chars, 1)", "shouts": f"{CELLS} * n_shouts / greatest(n_words, 1)",
        "dup_lines": f"{CELLS} * n_dup_lines / greatest(n_lines, 1)", "repeats": f"{CELLS} * n_repeat_words / greatest(n_words, 1)",
    }
    cells = ", ".join(f"CAST(least({CELLS}, floor({m})) AS INTEGER) AS {r}" for r, m in measures.items())
    long = " UNION ALL ".join(f"SELECT stratum, good, '{r}' AS rule, {r} AS cell FROM held" for r in RULES)
    hit = ", ".join(f"CASE WHEN m.{r} >= (SELECT cutoff FROM cuts WHERE rule = '{r}' AND stratum IS NOT DISTINCT FROM m.stratum) THEN '{r}' END" for r in RULES)
    share = RISK / len(RULES)
    term = f"exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share}))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    places AS (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8),
    win AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS s FROM places),
    rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, s) > 1),
    cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
    base AS (SELECT w.rid, doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, length(text) - length(replace(text, '!', '')) AS n_shouts,
      length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS n_upper, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
    m AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {cells} FROM base),
    good AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    held AS (SELECT m.*, good FROM m JOIN good USING (doc_id) WHERE NOT base_failed),
    counts AS (SELECT stratum, rule, cell, count(*) FILTER (good = 1) AS good, count(*) FILTER (good = 0) AS bad FROM ({long}) GROUP BY ALL),
    summed AS (SELECT stratum, rule, cell, sum(good) OVER o AS k, sum(bad) OVER o AS caught, CAST(sum(good) OVER (PARTITION BY stratum, rule) AS BIGINT) AS n FROM counts WINDOW o AS (PARTITION BY stratum, rule ORDER BY cell DESC ROWS UNBOUNDED PRECEDING)),
    strata AS (SELECT count(DISTINCT coalesce(stratum, chr(0))) AS strata FROM counts),
    sizes AS (SELECT DISTINCT n FROM summed),
    cdf AS (SELECT n, i, sum({term}) OVER (PARTITION BY n ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM (SELECT n, unnest(range(0, CAST(floor(n * {share}) AS BIGINT) + 1)) AS i FROM sizes)),
    most AS (SELECT n, max(i) AS most FROM cdf, strata WHERE c <= {CONFIDENCE} / ({len(RULES)} * strata) GROUP BY n),
    cuts AS (SELECT stratum, rule, cell AS cutoff FROM summed JOIN most USING (n) WHERE k <= most AND cell > 0 AND caught > {COST} * k
      QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - {COST} * k DESC, cell DESC) = 1),
    out AS (SELECT m.*, array_to_string(list_filter([{hit}], lambda x: x IS NOT NULL), ',') AS rejected_by FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by = '' AS kept, rejected_by FROM out
    """
