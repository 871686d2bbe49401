"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chat, filter_audit, jaccard, langid, merkle, mixing, neighbours, packing, pii, suffixes, token_counts, topk, toxicity
from ledgerline.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, root: str) -> DataFrame:
            ship(spark)
            return function(lambda table: spark.read.parquet(f"{root}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_exact_top_k", """
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
               FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def exact_top_k(table):
    return topk.search(table("embeddings"), k=5, every=50, head=16)


@query("op3_nearest_neighbours")
def nearest_neighbours(table):
    return neighbours.search(table("embeddings"), k=20, every=20)


@query("op9_ngram_jaccard_join")
def ngram_jaccard_join(table):
    _, found = jaccard.similar_sets(table("documents"), words=3, num=9, den=10)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id", "n_links")


@query("op5_curve_packing")
def curve_packing(table):
    return packing.pack(table("documents"), packing.vocabulary("byte_bpe_50k.json"))


@query("op7_token_counts")
def count_tokens(table):
    return token_counts.token_counts(table("documents"), packing.vocabulary("word_bpe_49k.json"))


@query("op4_language_id")
def language_id(table):
    return langid.identify(table("documents"))


@query("op6_toxicity")
def toxic_severity(table):
    return toxicity.severity(table("documents"), table("labels"))


@query("op8_source_mixing")
def source_mixing(table):
    _, rows = mixing.copies(table("documents"), mixing.Target(passes=1.25), packing.vocabulary("byte_bpe_50k.json"))
    return rows.select("doc_id", "source", F.col("__weight").alias("weight"), F.col("__copies").alias("copies"),
                       F.col("__block").alias("block"), F.col("__place").alias("place"))


_ESCAPED = r"""regexp_replace(regexp_replace(regexp_replace(replace({0}, '\', '\\'), '<(\||s>|/s>|<SYS>>|</SYS>>)', '\\l\1', 'g'),
    '\[(INST\]|/INST\])', '\\b\1', 'g'), '\|(>)', '\\p\1', 'g')"""


@query("op10_chat_format", rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
        sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
        sum({len(chat.TURN + chat.BODY + chat.END)} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
    FROM rows GROUP BY conv_id""")
def chat_format(table):
    rows = table("conversations").select("conv_id", "turn", "role", "text")
    said = "named_struct('conv_id', -7L, 'turn', {}L, 'role', '{}', 'text', '</s>[INST] ok [/INST]')"
    more = rows.sparkSession.sql(f"SELECT inline(array({said.format(0, 'user')}, {said.format(1, 'assistant')}))")
    return chat.digests(rows.unionByName(more))


@query("op2_pii_spans")
def pii_spans(table):
    return pii.spans(table("documents"))


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query("op12_filter_audit", rf"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    first AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
    marked AS (SELECT doc_id, part, map([{", ".join(f"'{f}'" for f in filter_audit.FILTERS)}],
        [len({_WORDS}) < 200, 100 * len(list_distinct({_WORDS})) < 50 * len({_WORDS}),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'), doc_id > first_id]) AS fails,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
      FROM texts JOIN first USING (text)),
    letters AS (SELECT unnest(string_split('{",".join(filter_audit.FILTERS)}', ',')) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders),
    seen AS (SELECT part, filter_order, step, filter_order[step] AS filter, good, toxic, coalesce(fails[filter_order[step]], false) AS fails_it,
        len(list_filter(string_split(filter_order[1:step - 1], ''), lambda x: coalesce(fails[x], false))) > 0 AS gone,
        len(list_filter(map_values(fails), lambda v: coalesce(v, false))) = 1 AS once
      FROM marked, steps),
    counted AS (SELECT part, filter_order, step, filter, count(*) FILTER (NOT gone AND NOT fails_it) AS kept, count(*) FILTER (NOT gone AND fails_it) AS removed,
        count(*) FILTER (gone AND fails_it) AS redundant, count(*) FILTER (fails_it AND once) AS unique_fails,
        count(*) FILTER (NOT gone AND fails_it AND good) AS good_lost, count(*) FILTER (NOT gone AND fails_it AND toxic) AS toxic_lost
      FROM seen GROUP BY ALL)
    SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM counted""")
def audit_filters(table):
    return filter_audit.audit(table("documents"), table("labels"))


def _hashed(*columns: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns) + ")"


def _levels(name: str, nodes: str, count: int) -> str:
    """CTEs name0 ... of a tree's levels: tree, p, n, h, and the siblings on the left and on the right (l, r)."""
    beside = lambda rows: f"coalesce(string_agg(h, '') OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN {rows}), '')"
    made = f"SELECT *, {beside('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, {beside('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r"
    up = "SELECT tree, p // 16 AS p, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h FROM {} GROUP BY tree, p // 16, n"
    return ", ".join([f"{name}0 AS ({made} FROM ({nodes}))"] + [f"{name}{k + 1} AS ({made} FROM ({up.format(name + str(k))}))" for k in range(count)])


def _folded(own: str, levels: list[str]) -> str:
    for t in levels:
        own = f"(SELECT CASE WHEN {t}.n > 1 THEN sha256({t}.l || f || {t}.r) ELSE f END FROM (SELECT {own} AS f))"
    return own


_LOW, _TOP = [f"d{k}" for k in range(8)], [f"s{k}" for k in range(4)]  # trees of up to 16^8 documents and 16^4 sources
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


@query("op11_merkle_manifest", f"""
    WITH leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {_hashed("doc_id", "source", "lang", "n_chars", "text")} AS h,
        CASE WHEN {_CRC} % 5 = 0 THEN {_hashed("doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
      FROM documents),
    placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    {_levels("d", "SELECT tree, p, n, h FROM placed", len(_LOW))},
    sources AS (SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS p, count(*) OVER () AS n, h FROM d{len(_LOW)}),
    {_levels("s", "SELECT tree, p, n, h FROM sources", len(_TOP))},
    whole AS (SELECT placed.doc_id, placed.h AS leaf, sources.h AS subroot, (SELECT h FROM s{len(_TOP)}) AS root,
        sha256({" || ".join(f"CASE WHEN {t}.n > 1 THEN {t}.l || {t}.r ELSE '' END" for t in _LOW + _TOP)}) AS proof_sha256,
        {_folded("coalesce(placed.other, placed.h)", _LOW + _TOP)} AS folded_root
      FROM placed JOIN sources ON sources.name = placed.tree
        {" ".join(f"JOIN {t} ON {t}.tree = placed.tree AND {t}.p = placed.p // {16 ** k}" for k, t in enumerate(_LOW))}
        {" ".join(f"JOIN {t} ON {t}.p = sources.p // {16 ** k}" for k, t in enumerate(_TOP))})
    SELECT *, folded_root = root AS verified FROM whole""")
def merkle_manifest(table):
    return merkle.audited(table("documents"))


@query("op13_suffix_dedup")
def suffix_dedup(table):
    return suffixes.deduped(table("documents"))
