"""The registered queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.llm.chat import format_chats, read_chats
from waypost.llm.decontaminate import find_leaks
from waypost.llm.divergence import source_divergence
from waypost.llm.exact_dedup import exact_groups
from waypost.llm.html_text import extract_text
from waypost.llm.jaccard import jaccard_components
from waypost.llm.packing import pack_documents
from waypost.llm.passages import repeated_passages
from waypost.llm.pii import BASE, find_spans, listed, of_kinds
from waypost.llm.quality import fit, score
from waypost.llm.spelling import MISSPELT, count_words, spelling_variants
from waypost.llm.token_counts import token_counts
from waypost.llm.url_filter import ORDER, judge_urls
from waypost.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_exact_dedup",
    r"""
    WITH t AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
        FROM documents
    )
    SELECT doc_id,
           min(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
           sha256(body) AS text_sha256
    FROM t
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so each run encodes every distinct text."""
    return token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        fresh_path(spark, "token-counts"),
    )


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return find_spans(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(of_kinds(spans, kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(of_kinds(spans, *BASE)), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        F.array_max(F.transform(spans, lambda s: s["score"])).alias("score"),
    )


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts hold the control strings of a common template.
CONTROLS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op6_chat")
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROLS, "conv_id long, turn long, role string, text string")
    return read_chats(format_chats(turns.union(more)))


@query("op7_ngram_jaccard")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, share=(85, 100))


@query("op8_passages")
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


@query(
    "op11_source_divergence",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'
               ) AS found
        FROM documents
    ),
    w AS (SELECT row, lang, source, unnest(found) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (
        SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total
        FROM (SELECT DISTINCT lang, source FROM d) AS g LEFT JOIN counts AS c ON (c.lang, c.source) = (g.lang, g.source)
        GROUP BY ALL
    ),
    cells AS (
        SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
               1 + 1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT // (t.total + 5 * v) AS p,
               1 + 1000000000 * (k.lang_n + 5)::HUGEINT // (lang_total + 5 * v) AS q
        FROM totals AS t JOIN kept AS k USING (lang) JOIN langs USING (lang)
        LEFT JOIN counts AS c ON (c.lang, c.source, c.term) = (t.lang, t.source, k.term)
    ),
    rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
        FROM totals AS a JOIN totals AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (
            SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
            FROM cells AS x JOIN cells AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
            GROUP BY ALL
        ) AS s ON (s.lang, s.source, s.item) = (a.lang, a.source, b.source)
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, value::BIGINT AS value,
           (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM rows
    QUALIFY part = 'pair' OR rank <= 50
    """,
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


# The rules of the query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _url_sql(order: int) -> str:
    """The models level by level, from the alphabet up."""
    kinds = ("allow", "block")
    levels = [
        f"""
        g{order + 1} AS (
            SELECT substr(repeat(chr(2), {order}) || url || chr(3), i, {order + 1}) AS gram,
                   count(*) FILTER (example = 'allow') AS allow, count(*) FILTER (example = 'block') AS block
            FROM spots GROUP BY 1
        )"""
    ]
    for k in range(order, 0, -1):
        levels.append(f"g{k} AS (SELECT substr(gram, 2) AS gram, sum(allow) AS allow, sum(block) AS block FROM g{k + 1} GROUP BY 1)")
    for k in range(1, order + 2):
        shares = []
        for kind in kinds:
            lower = f"{kind}_chance" if k > 1 else "1.0 / (SELECT count(*) FROM g1)::DOUBLE"
            total, many = f"(sum({kind}) OVER c)::DOUBLE", f"(count(*) FILTER ({kind} > 0) OVER c)::DOUBLE"
            shares.append(
                f"CASE WHEN {total} > 0 THEN ({kind}::DOUBLE + {many} * {lower}) / ({total} + {many}) ELSE {lower} END AS {kind}_chance"
            )
        source = f"g{k}" if k == 1 else f"(SELECT g{k}.*, allow_chance, block_chance FROM g{k} JOIN p{k - 1} ON substr(g{k}.gram, 2) = p{k - 1}.gram)"
        levels.append(
            f"p{k} AS (SELECT gram, {', '.join(shares)} FROM {source} WINDOW c AS (PARTITION BY substr(gram, 1, {k - 1})))"
        )
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return f"""
    WITH parts AS (
        SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages
    ),
    rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
    best AS (
        SELECT row, max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict), length(rule_host || rule_path)) AS r
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY row
    ),
    u AS (
        SELECT parts.*, r.rule AS rule, r.verdict AS ruled, ('0x' || substr(md5(url), 1, 8))::BIGINT % 5 = 0 AS held
        FROM parts LEFT JOIN best USING (row)
    ),
    spots AS (
        SELECT row, url, CASE WHEN NOT held THEN ruled END AS example, unnest(range(1, length(url) + 2)) AS i FROM u
    ),
    {", ".join(levels)},
    model AS (SELECT gram, round((ln(allow_chance) - ln(block_chance)) / 1e-6)::BIGINT AS weight FROM p{order + 1}),
    scored AS (
        SELECT row, floor(sum(weight)::DOUBLE / count(*))::BIGINT AS mean
        FROM spots JOIN model ON substr(repeat(chr(2), {order}) || url || chr(3), i, {order + 1}) = gram GROUP BY row
    ),
    bins AS (
        SELECT floor(mean / 1000.0)::BIGINT AS bin, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
        FROM u JOIN scored USING (row) WHERE held AND ruled IS NOT NULL GROUP BY 1
    ),
    gains AS (
        SELECT floor((coalesce(lead(bin) OVER up + 1, bin) + bin) * 1000 / 2.0)::BIGINT AS cut,
               sum(a) OVER up * (SELECT sum(b) FROM bins) - sum(b) OVER up * (SELECT sum(a) FROM bins) AS gain
        FROM bins WINDOW up AS (ORDER BY bin DESC)
    ),
    cut AS (
        SELECT CASE WHEN (SELECT least(sum(a), sum(b)) FROM bins) > 0
                    THEN (SELECT cut FROM gains ORDER BY gain DESC, abs(cut), cut DESC LIMIT 1) ELSE 0 END AS threshold
    )
    SELECT page_id, host, path, rule,
           coalesce(ruled, CASE WHEN mean >= threshold THEN 'allow' ELSE 'block' END) AS verdict,
           mean AS score, threshold::BIGINT AS threshold
    FROM u JOIN scored USING (row), cut
    """


@query("op12_url_filter", _url_sql(ORDER))
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query(
    "op13_spelling_variants",
    r"""
    WITH RECURSIVE steps AS (
        SELECT list_transform(range(256), lambda x: list_reduce(
            list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
    ),
    runs AS (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
            FROM documents
        ) WHERE length(run) >= 7 GROUP BY ALL
    ),
    hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
            list_prepend(4294967295, flatten(list_transform(
                string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [195, unicode(s)::BIGINT - 64] END))),
            lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h
        FROM runs, steps
    ),
    spelt AS (
        SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed
    ),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cut AS (
        SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
    ),
    near AS (
        SELECT x.word, y.word AS other, y.n AS other_n FROM cut AS x JOIN cut AS y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION
        SELECT x.word, y.word, y.n FROM cut AS x JOIN words AS y ON y.word = x.a || x.b
        UNION
        SELECT y.word, x.word, x.n FROM cut AS x JOIN words AS y ON y.word = x.a || x.b
    ),
    best AS (
        SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
        FROM near GROUP BY word
    ),
    formed AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
               CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
        FROM words LEFT JOIN best USING (word)
    ),
    chain AS (
        SELECT word, form AS last FROM formed WHERE form IS NOT NULL
        UNION ALL
        SELECT c.word, f.form FROM chain AS c JOIN formed AS f ON f.word = c.last WHERE f.form IS NOT NULL
    ),
    ends AS (SELECT c.word, c.last FROM chain AS c JOIN formed AS f ON f.word = c.last WHERE f.form IS NULL)
    SELECT word, form, coalesce(last, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)
    """,
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(table(spark, sf_dir, "documents"), one_in=MISSPELT))
