"""Personal data: patterns, and terms that reveal what the patterns found, in DataFrame expressions only.

The base kinds (email, ip, card, phone) are matched by pattern and checked. Their values are the protected entities.
A term is revealing if the corpus shows it with one entity so often that reading the term tells the entity: with
contexts (the NEAR words on either side of an entity within its line, cut at white space and at entities) counted once each, the share of the different lines
with the term that are contexts of the entity has a lower confidence bound (Wilson, BOUND standard errors); the information
on the entity that is left open once the term is read, -ln(bound), must be at most 1 - DISCLOSURE of the information of the
entity itself, ln(lines / contexts of the entity). A single context is no repetition and reveals nothing: LEAST_TOGETHER
different ones are asked for. Lines count once each however often they are repeated, so copies of a document make no term
revealing. Revealing terms are reported wherever they occur, as kind "term"; sanitise() removes direct identifiers and
generalises revealing terms.

Null texts count as empty. Positions are code points, ends exclusive. Repeated rows give repeated rows. Documents
are told apart by a 64-bit hash of id and text, so null and repeated ids do no harm. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_SQL, packed, texts, written

DISCLOSURE, LEAST_TOGETHER, NEAR, BOUND = 0.8, 2, 8, 1.96
#: Items folded at a time.
BLOCK = 256
SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"
KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. A run that cannot match from its start cannot match from within, so matching begins
# at the start of a run or where the last match ended (\G), and repeats are possessive: time stays linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _ok(kind: str, m: str) -> str:
    """SQL that tells whether a match counts."""
    digits = f"regexp_replace({m}, '[^0-9]+', '')"
    if kind == "ip":
        return f"forall(split({m}, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)"
    if kind == "phone":
        return f"length({digits}) BETWEEN 10 AND 15"
    if kind == "card":
        doubled = "CASE WHEN i % 2 = 0 THEN d WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END"
        luhn = f"aggregate(transform(transform(split(reverse({digits}), ''), c -> coalesce(try_cast(c AS int), 0)), (d, i) -> {doubled}), 0, (a, x) -> a + x) % 10 = 0"
        return f"CASE WHEN length({digits}) BETWEEN 14 AND 19 THEN {luhn} ELSE false END"
    return "true"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def with_spans(df: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """Adds an array of (start, kind number, end, value) in order, null where nothing matched.

    Positions come from the lengths of the matches and of what stands between them, which split() gives.
    """
    kinds = list(PATTERNS)
    got = df.withColumns({f"_m{k}": F.expr(f"regexp_extract_all({text}, {_literal(PATTERNS[n])}, 0)") for k, n in enumerate(kinds)})
    rest = got.withColumns({f"_p{k}": F.expr(f"CASE WHEN size(_m{k}) > 0 THEN split({text}, {_literal(PATTERNS[n])}, -1) END") for k, n in enumerate(kinds)})
    spans = {}
    for k, n in enumerate(kinds):
        step = (
            f"(a, i) -> named_struct('at', a.at + length(_p{k}[i]) + length(_m{k}[i]), 'out', concat(a.out, array(named_struct("
            f"'start', a.at + length(_p{k}[i]), 'kind', {k}, 'end', a.at + length(_p{k}[i]) + length(_m{k}[i]), 'value', _m{k}[i]))))"
        )
        # BLOCK matches at a time, so that a text with many of them does not copy a long array for each
        inner = f"aggregate(sequence(b * {BLOCK}, least(size(_m{k}), (b + 1) * {BLOCK}) - 1), named_struct('at', o.at, 'out', cast(array() AS {SPANS})), {step})"
        outer = f"(o, b) -> transform(array({inner}), x -> named_struct('at', x.at, 'out', concat(o.out, array(x.out))))[0]"
        fold = f"aggregate(sequence(0, (size(_m{k}) - 1) div {BLOCK}), named_struct('at', 0, 'out', cast(array() AS array<{SPANS}>)), {outer}, o -> flatten(o.out))"
        spans[f"_s{k}"] = F.expr(f"CASE WHEN size(_m{k}) > 0 THEN filter({fold}, x -> {_ok(n, 'x.value')}) END")
    whole = rest.withColumns(spans)
    any_ = " OR ".join(f"size(_s{k}) > 0" for k in range(4))
    none = f"cast(array() AS {SPANS})"
    joined = ", ".join(f"coalesce(_s{k}, {none})" for k in range(4))
    return whole.withColumn(out, F.expr(f"CASE WHEN {any_} THEN array_sort(concat({joined})) END")).drop(*[f"_{x}{k}" for x in "mps" for k in range(4)])


def _words(part: str) -> str:
    return f"filter(split({part}, '{SPACE_SQL}+'), w -> w != '')"


def contexts(found: DataFrame) -> DataFrame:
    """entity and near: the NEAR words before and after each entity, once for each different context.

    A line is cut at its entities and at white space once; an entity's words are a slice of that list around its place.
    """
    lines = found.where("found IS NOT NULL").select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike("[0-9@]")).distinct()
    spotted = with_spans(lines, "line", "inside").where("inside IS NOT NULL")
    pieces = "array<struct<before:string,entity:string,value:string>>"
    gap = "CASE WHEN x.start > a.at THEN substring(line, a.at + 1, x.start - a.at) ELSE '' END"
    step = f"(a, x) -> named_struct('at', greatest(a.at, x.end), 'out', concat(a.out, array(named_struct('before', {gap}, 'entity', concat(x.kind, ':', x.value), 'value', x.value))))"
    inner = f"aggregate(slice(inside, b * {BLOCK} + 1, {BLOCK}), named_struct('at', o.at, 'out', cast(array() AS {pieces})), {step})"
    outer = f"(o, b) -> transform(array({inner}), x -> named_struct('at', x.at, 'out', concat(o.out, array(x.out))))[0]"
    fold = f"aggregate(sequence(0, (size(inside) - 1) div {BLOCK}), named_struct('at', 0, 'out', cast(array() AS array<{pieces}>)), {outer}, o -> struct(flatten(o.out) AS out, o.at AS at))"
    cut = spotted.withColumn("c", F.expr(fold)).withColumn("words", F.expr(f"transform(c.out, p -> {_words('p.before')})")).withColumn("sizes", F.expr("transform(words, w -> size(w))"))
    tokens = f"concat(flatten(transform(words, (w, i) -> concat(w, array(c.out[i].value)))), {_words('substring(line, c.at + 1)')})"
    listed = cut.withColumn("tokens", F.expr(tokens)).withColumn("at", F.expr(_starts("sizes")))
    place = "(at[i] + sizes[i])"  # of the entity among the tokens, from 0
    near = f"concat(reverse(slice(tokens, greatest(1, {place} + 1 - {NEAR}), least({NEAR}, {place}))), slice(tokens, {place} + 2, {NEAR}))"
    each = listed.select(F.explode(F.expr(f"transform(c.out, (p, i) -> struct(p.entity AS entity, {near} AS near))")).alias("x"))
    return each.select("x.entity", "x.near").distinct()


#: Punctuation around a word; matching begins at its first character only, so that long runs of it take linear time.
EDGES = r"^[^\\p{L}\\p{N}]++|(?<![^\\p{L}\\p{N}])[^\\p{L}\\p{N}]++$"
BETWEEN = r"(?<![^\\p{L}\\p{N}\\x20\\x09-\\x0D])[^\\p{L}\\p{N}\\x20\\x09-\\x0D]*+[\\x20\\x09-\\x0D][^\\p{L}\\p{N}]*+"


def plain(word: str) -> str:
    """SQL for a word as a term: small letters, without the punctuation around it."""
    return f"regexp_replace(lower({word}), '{EDGES}', '')"


def terms_of(text: str) -> str:
    """SQL for the distinct terms of a text, in one cut."""
    return f"array_distinct(split({plain(text)}, '{BETWEEN}'))"


def revealing_terms(docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE, together: int = LEAST_TOGETHER) -> DataFrame:
    """Terms that reveal an entity: entity, term, joint, disclosure."""
    seen = written(contexts(found), "pii-contexts")
    pairs = seen.select("entity", F.explode(F.expr(f"array_distinct(transform(near, w -> {plain('w')}))")).alias("term")).where(F.col("term").rlike(r"\p{L}") & (F.col("term") != F.lower(F.expr("substring(entity, 3)"))))
    joint = written(pairs.groupBy("entity", "term").agg(F.count("*").alias("joint")).where(F.col("joint") >= together), "pii-joint")
    if joint.isEmpty():
        return joint.withColumn("disclosure", F.lit(None).cast("double"))
    # counts over the lines of the whole corpus, each different line once; a line's end stands for the line itself
    lines = texts(docs).select(F.explode(F.expr("array_distinct(split(text, '\\n'))")).alias("line")).where("line != ''")
    different = lines.groupBy(F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g")).agg(F.first("line").alias("line"))
    wanted = written(joint.select("term").unionByName(docs.sparkSession.range(1).select(F.lit("\n").alias("term"))).distinct(), "pii-candidates")
    counts = different.select(F.explode(F.expr(f"concat({terms_of('line')}, array('\\n'))")).alias("term")).join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    n_term = written(counts, "pii-counts")
    total = n_term.where("term = '\n'").select(F.col("n_term").alias("total"))
    n_entity = seen.groupBy("entity").agg(F.count("*").alias("n_entity"))
    scored = joint.join(n_term, "term").join(n_entity, "entity").join(F.broadcast(total))  # one row
    n = F.greatest("n_term", "joint")
    p, z = F.col("joint") / n, BOUND**2
    bound = (p + z / (2 * n) - F.sqrt(z * (p * (1 - p) + z / (4 * n)) / n)) / (1 + z / n)
    info = F.log(F.greatest(F.col("total") / F.col("n_entity"), F.lit(1.0000001)))
    return scored.select("entity", "term", "joint", (1 + F.log(F.greatest(bound, F.lit(1e-300))) / info).alias("disclosure")).where(F.col("disclosure") >= disclosure)


def _starts(sizes: str) -> str:
    """SQL for the positions of pieces of these sizes with one character between them, BLOCK pieces at a time."""
    step = "(a, n) -> named_struct('at', a.at + n + 1, 'out', concat(a.out, array(a.at)))"
    inner = f"aggregate(slice({sizes}, b * {BLOCK} + 1, {BLOCK}), named_struct('at', o.at, 'out', cast(array() AS array<int>)), {step})"
    outer = f"(o, b) -> transform(array({inner}), x -> named_struct('at', x.at, 'out', concat(o.out, array(x.out))))[0]"
    return f"aggregate(sequence(0, (size({sizes}) - 1) div {BLOCK}), named_struct('at', 0, 'out', cast(array() AS array<array<int>>)), {outer}, o -> flatten(o.out))"


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """key and an array of the spans of the given terms in it; docs: key and text."""
    known = written(terms.select("term").distinct(), "pii-terms")
    if known.isEmpty():
        return known.select(F.lit(None).cast("long").alias("key"), F.lit(None).cast("array<struct<start:int,kind:int,end:int>>").alias("terms"))
    # the texts that hold a term are found first, so that words are placed in those alone
    holders = docs.select("key", F.explode(F.expr(terms_of("text"))).alias("term")).join(known, "term", "left_semi").select("key").distinct()
    cut = docs.join(holders, "key", "left_semi").dropDuplicates(["key"]).select("key", F.split("text", SPACE).alias("words"))
    placed = cut.withColumn("sizes", F.expr("transform(words, w -> length(w))")).select("key", F.explode(F.arrays_zip("words", F.expr(_starts("sizes")).alias("at"))).alias("x"))
    each = placed.select("key", F.col("x.words").alias("word"), F.col("x.at").alias("at")).withColumn("term", F.expr(plain("word"))).join(known, "term")
    lead = r"length(word) - length(regexp_replace(word, '^[^\\p{L}\\p{N}]++', ''))"
    span = each.select("key", F.expr(f"struct(at + {lead} AS start, 4 AS kind, at + {lead} + length(term) AS end)").alias("x"))
    return span.groupBy("key").agg(F.array_sort(F.collect_set("x")).alias("terms"))


def _keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key (a hash of id and text) tells documents apart whose id is null or repeated."""
    return texts(docs, doc_id, text).withColumn("key", F.xxhash64("doc_id", "text"))


def _found(docs: DataFrame, disclosure: float, together: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, and the columns of find_personal_data()."""
    given = _keyed(docs, doc_id, text)
    spotted = with_spans(given)
    # the texts with an entity are kept for their contexts; of the others only the id is
    kept = written(spotted.select("key", "doc_id", F.when(F.col("found").isNotNull(), F.col("text")).alias("text"), "found"), "pii")
    terms = term_spans(given, revealing_terms(given, kept, disclosure, together))
    base = F.coalesce(F.expr("transform(found, x -> struct(x.start AS start, x.kind AS kind, x.end AS end))"), F.expr("cast(array() AS array<struct<start:int,kind:int,end:int>>)"))
    whole = kept.select("key", "doc_id", base.alias("base")).join(terms, "key", "left")
    names = ", ".join(f"'{k}'" for k in KINDS)
    show = lambda a: F.expr(f"array_join(transform({a}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')")
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = {k})))").alias(f"n_{KINDS[k]}") for k in range(4)]
    return (
        whole.withColumn("found", F.expr("array_sort(concat(base, coalesce(terms, cast(array() AS array<struct<start:int,kind:int,end:int>>))))"))
        .select("key", "doc_id", *counts, F.sha2(show("base"), 256).alias("base_sha256"), show("found").alias("spans"), F.size("found").cast("long").alias("n_found"), "found")
    )


def find_personal_data(docs: DataFrame, disclosure: float = DISCLOSURE, together: int = LEAST_TOGETHER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base kinds, all spans as text, their number n_found, and as an array found."""
    return _found(docs, disclosure, together, doc_id, text).drop("key")


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, together: int = LEAST_TOGETHER) -> DataFrame:
    """The documents with direct identifiers replaced by their kind in brackets and revealing terms by their first letter."""
    found = _found(docs, disclosure, together).where("size(found) > 0").select(F.col("key").alias("_key"), F.col("found").alias("_spans")).dropDuplicates(["_key"])
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # the pieces are gathered in an array and joined once, so that a long text with many spans is not copied for each
    step = (
        f"(a, x) -> CASE WHEN x.start >= a.at THEN named_struct('out', concat(a.out, array(substring(text, a.at + 1, x.start - a.at), "
        f"CASE WHEN x.kind = 4 THEN concat(substring(text, x.start + 1, 1), '.') ELSE element_at(array({names}), x.kind + 1) END)), 'at', x.end) "
        f"ELSE named_struct('out', a.out, 'at', greatest(a.at, x.end)) END"
    )
    fold = f"aggregate(_spans, named_struct('out', cast(array() AS array<string>), 'at', 0), {step}, a -> array_join(concat(a.out, array(substring(text, a.at + 1))), ''))"
    keyed = packed(docs).withColumn("_key", F.xxhash64("doc_id", "text")).join(found, "_key", "left")
    clean = F.expr(f"CASE WHEN _spans IS NULL OR row.text IS NULL THEN row.text ELSE {fold} END")
    return keyed.select(F.col("row").withField("text", clean).alias("row")).select("row.*")
