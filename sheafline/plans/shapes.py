"""The given tables in the shape of assembly tables. Every expression means the same in Spark and in DuckDB."""

from __future__ import annotations

from ..session import table

Q = "CAST(floor(l_quantity) AS BIGINT)"
PERCENT = "CAST(floor(l_discount * 100 + 0.5) AS BIGINT)"
DOMAIN = "CASE WHEN {k} < 15 THEN 'Bacteria' WHEN {k} < 20 THEN 'Archaea' WHEN {k} < 23 THEN 'Eukaryota' ELSE 'Unclassified' END"

#: name: (table, {column: expression})
SHAPES = {
    "contigs": ("customer", {
        "contig": "c_custkey", "length": "1000 + 3 * CAST(floor(abs(c_acctbal)) AS BIGINT)",
        "tiara": "CASE c_mktsegment WHEN 'BUILDING' THEN 'bacteria' WHEN 'AUTOMOBILE' THEN 'archaea' WHEN 'MACHINERY' THEN 'eukarya' WHEN 'HOUSEHOLD' THEN 'organelle' END",
        "domain": DOMAIN.format(k="c_nationkey"), "genus": "CASE WHEN c_nationkey < 23 THEN concat('g', c_nationkey) ELSE 'Unclassified' END",
        "kingdom": "CASE WHEN c_nationkey IN (20, 21) THEN 'Metazoa' WHEN c_nationkey = 22 THEN 'Viridiplantae' ELSE 'Unclassified' END",
        "support": "c_nationkey / 32.0E0", "gc": "0.25E0 + c_custkey % 64 / 128.0E0", "depth": "CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 64) / 4.0E0 END",
    }),
    "orfs": ("orders", {
        "contig": "o_custkey", "orf": "o_orderkey", "start": "o_orderkey % 3000 + 1", "stop": "o_orderkey % 3000 + 1 + CAST(floor(o_totalprice) AS BIGINT) % 900",
        "strand": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END",
    }),
    "alignments": ("lineitem", {
        "qname": "l_orderkey", "rname": "l_suppkey", "pos": "l_partkey + 1", "mapq": Q, "nm": PERCENT,
        "flag": "CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END + CASE WHEN l_returnflag = 'R' THEN 16 ELSE 0 END + CASE WHEN l_linenumber > 3 THEN 256 ELSE 0 END + CASE WHEN l_quantity < 4 THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 2 ELSE 0 END",
        "cigar": f"concat(l_linenumber, 'S', 20 + {Q}, 'M', l_linenumber, 'D', 40, 'M')",
        "qual": f"concat(repeat('I', CAST(l_linenumber + 20 AS INT)), repeat(CASE WHEN l_discount > 0.05 THEN '#' ELSE 'I' END, CAST({Q} AS INT)), repeat('I', 40))",
        "tlen": "CAST(floor(l_extendedprice / 50) AS BIGINT)", "pnext": f"l_partkey + 10 * {Q}", "score": "CAST(floor(l_extendedprice) AS BIGINT)",
    }),
    "paf": ("lineitem", {"qname": "l_suppkey", "lo": "l_partkey - 20", "hi": f"l_partkey - 20 + 3 * {Q}", "nmatch": f"{Q} * (100 - {PERCENT})", "alen": f"{Q} * 100", "bin": "l_returnflag"}),
    "originals": ("supplier", {"contig": "s_suppkey", "length": "400 + CAST(floor(abs(s_acctbal)) AS BIGINT) % 4000", "bin": "concat('b', s_nationkey)", "domain": DOMAIN.format(k="s_nationkey")}),
    "domains": ("lineitem", {
        "bin": "l_partkey % 20", "protein": "l_orderkey", "accession": "concat('M', l_suppkey % 40)", "seq_score": "CAST(floor(l_extendedprice / 100) AS BIGINT)",
        "dom_score": f"CAST(floor(l_extendedprice / 100) AS BIGINT) - {PERCENT}", "ievalue": "CAST(floor(l_tax * 100 + 0.5) AS BIGINT)", "hmm_from": "l_partkey % 60 + 1", "hmm_to": f"l_partkey % 60 + 1 + {Q}",
    }),
    "models": ("supplier", {
        "accession": "concat('M', s_suppkey)", "model": "s_suppkey", "length": "60 + s_suppkey % 50", "seq_cut": "CAST(floor(abs(s_acctbal) / 20) AS BIGINT)", "dom_cut": "CAST(floor(abs(s_acctbal) / 25) AS BIGINT)",
        "target": "concat('t', s_suppkey % 9)", "call": "CASE WHEN s_suppkey % 3 = 0 THEN 'specific' WHEN s_suppkey % 3 = 1 THEN 'shared_family' ELSE 'domain_only' END",
        "context_only": "s_suppkey % 11 = 0", "least": "(s_suppkey % 5) / 16.0E0", "component": "concat('k', s_suppkey % 7)",
    }),
    "features": ("events", {
        "contig": "user_id", "locus": "event_id", "kind": "CASE event_type WHEN 'view' THEN 'cds' WHEN 'click' THEN 'cds' WHEN 'error' THEN 'tRNA' WHEN 'signup' THEN 'rRNA' ELSE 'crispr' END",
        "product": "CASE WHEN value < 3 THEN 'hypothetical protein' WHEN value < 4 THEN 'Hypothetical Protein, partial' ELSE concat(event_type, ' kinase') END", "at": "event_id % 5000 + 1", "props": "props",
    }),
    "bins": ("nation", {
        "bin": "n_name", "rank": "CASE n_regionkey WHEN 0 THEN 'genus' WHEN 1 THEN 'family' WHEN 2 THEN 'species' WHEN 3 THEN 'clade' ELSE 'order' END", "bp": "n_nationkey * n_nationkey * 1000",
        "completeness": "CASE WHEN n_nationkey % 4 <> 0 THEN 40 + n_nationkey * 2.5E0 END", "contamination": "CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey / 2.0E0 END", "contigs": "n_nationkey + 1", "region": "n_regionkey",
    }),
}


def shape(spark, d: str, name: str):
    source, columns = SHAPES[name]
    return table(spark, d, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def sql(*names: str) -> str:
    """The shapes as common table expressions."""
    return ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in SHAPES[n][1].items())} FROM {SHAPES[n][0]})" for n in names)


def crc_sql(text: str, start: int = 17) -> str:
    """DuckDB's SQL for the CRC-32 of a short text of ASCII letters, continued from a start value."""
    table_ = "range(256)"
    for _ in range(8):
        table_ = f"list_transform({table_}, lambda c: xor(c >> 1, 3988292384 * (c & 1)))"
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST({start ^ 0xFFFFFFFF} AS BIGINT)], {bytes_}), lambda a, x: xor(a >> 8, ({table_})[CAST(xor(a, x) & 255 AS INTEGER) + 1])), 4294967295)"
