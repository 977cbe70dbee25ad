"""The training-data operators bound to the shared tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import balanced_packing, exact_dedup, license_scan, lexical_search, mixing, near_dedup, packing, prefix_trie, quality
from . import secret_scan, token_counts, token_files, warc
from .common import ship, table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        LLM_QUERIES[name] = run
        if sql is not None:
            LLM_ORACLES[name] = sql
        return fn

    return keep


@register("op1_mixing_weights")
def op1_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


@register(
    "op2_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.content_groups(table(spark, sf_dir, "documents"), keep="largest")


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = token_counts.prefix_table(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    cut = token_counts.cut_for_budget(tables, token_counts.LIMIT)
    return cut.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"), "cut_chars")


@register("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(license_scan.ordinary_paragraphs(docs, "doc_id", "text")))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value
_FIVE_BITS = " + ".join(f"{16 >> k} * CAST(bits[5 * i + {k + 1}] AS INTEGER)" for k in range(5))


@register(
    "op5_warc",
    f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
             d AS (SELECT page_id, octet_length(body) AS payload_bytes, min(page_id) OVER (PARTITION BY body) AS first_id,
                          CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST(1 + {_FIVE_BITS} AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM d""",
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).drop("url")


@register("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secret_scan.train(secret_scan.labelled_findings(spark))
    return secret_scan.scan(table(spark, sf_dir, "documents"), model)


@register("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return token_files.read_tokens(*written, kind=kind, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packed.drop("ids")


@register("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"), words=4).drop("mark")


@register("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register("op11_cost_packing")
def op11_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = balanced_packing.pack_balanced(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packed.drop("ids")


@register(
    "op12_ranked_search",
    r"""WITH terms AS (
          SELECT d.row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents) d),
        counts AS (SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row),
        whole AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
        norms AS (SELECT row, 10 + (90 * n * all_docs) // all_terms AS m FROM sizes, whole),
        weights AS (SELECT term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, whole GROUP BY term, all_docs),
        items AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
        asked AS (SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
        scores AS (SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
                   FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (row) GROUP BY ALL),
        ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents"))
    found = lexical_search.search(index, table(spark, sf_dir, "benchmark"), top=10)
    return found.select("item_id", "rank", "doc_id", "score")


@register(
    "op13_prefix_trie",
    """WITH RECURSIVE
        t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id
                     ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
              FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT DISTINCT c, c::VARCHAR AS s FROM t),
        bits(c, s, i, v) AS (
          SELECT c, s, 0, 4294967295::BIGINT FROM convs
          UNION ALL
          SELECT c, s, i + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384) ELSE w >> 1 END
          FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(s, i // 8 + 1, 1))::BIGINT) ELSE v END AS w FROM bits WHERE i < 8 * length(s))),
        plan AS (SELECT c, c - c % 100 AS leader, xor(v, 4294967295) % 6 AS h FROM bits WHERE i = 8 * length(s)),
        lead AS (SELECT plan.c, plan.h, t.p, t.r, t.x FROM plan JOIN t ON t.c = plan.leader AND t.p <= plan.h),
        shift AS (SELECT plan.c, any_value(plan.h) AS h, count(lead.p) - any_value(plan.h) AS by_ FROM plan LEFT JOIN lead USING (c) GROUP BY plan.c),
        turns AS (SELECT c, p AS d, r, x FROM lead
                  UNION ALL SELECT t.c, t.p + shift.by_ AS d, r, x FROM t JOIN shift ON t.c = shift.c AND t.p > shift.h),
        steps AS (SELECT c, 0 AS d, '' AS k, 0 AS chars FROM convs
                  UNION ALL SELECT c, d, sha256(length(r) || ':' || r || x), length(x) FROM turns),
        inst AS (SELECT c, d, chars, sha256(string_agg(k, ' ') OVER (PARTITION BY c ORDER BY d)) AS node, d = max(d) OVER (PARTITION BY c) AS last FROM steps),
        nodes AS (SELECT d, node, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars, bool_and(last) AS leaf,
                         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256 FROM inst GROUP BY d, node),
        up AS (SELECT u.conv_id, u.d, p.conv_id AS parent_conv_id, p.d AS pd FROM nodes u JOIN inst i ON i.c = u.conv_id AND i.d = u.d - 1
               JOIN nodes p ON p.node = i.node AND p.d = i.d),
        kids AS (SELECT parent_conv_id AS conv_id, pd AS d, count(*) AS n_children FROM up GROUP BY ALL),
        below AS (SELECT i.d, i.node, sum(u.leaf::INTEGER)::BIGINT AS n_leaves, sum((u.n - 1) * u.chars)::BIGINT AS saved_tokens
                  FROM nodes u JOIN inst i ON i.c = u.conv_id AND i.d <= u.d GROUP BY i.d, i.node)
        SELECT nodes.conv_id, nodes.d::BIGINT AS depth, up.parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
        FROM nodes JOIN below ON below.d = nodes.d AND below.node = nodes.node LEFT JOIN up ON up.conv_id = nodes.conv_id AND up.d = nodes.d
             LEFT JOIN kids ON kids.conv_id = nodes.conv_id AND kids.d = nodes.d""",
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.crc32(F.col("conv").cast("string")) % 6
    turns = prefix_trie.shared_turns(table(spark, sf_dir, "conversations"), heads, F.col("conv") - F.col("conv") % 100, most=5)
    return prefix_trie.trie(turns)
