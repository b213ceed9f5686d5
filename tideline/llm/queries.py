"""The registered queries of the training-data operators, and their SQL where it exists.

Each query applies one operator, with production parameters, to its whole table and
derives the agreed columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses, packing, sentencepieces, sharding, simhash, topk, url_filter
from .common import labelled_by_crc, table, text_or_empty, utf8
from .exact_dedup import mark_duplicates
from .quality import fit_quality, score_quality
from .toxicity import fit_toxicity, score_toxicity

SHARDS = 40
URL_RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled page outcomes: labels carry the page's number; bad = low quality or toxic."""
    labels = table(spark, sf_dir, "labels")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, page_outcomes(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _op1_sql() -> str:
    """The same shrinkage, level by level, in DuckDB."""
    rules = ", ".join(
        f"('{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{what}')" for rule, what in URL_RULES
    )
    suffixes = ", ".join(f"'{s}'" for s in url_filter.TWO_LABEL_SUFFIXES)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def level(name: str, source: str) -> str:
        noise = "n * p * (1 - p)"
        return f"""{name}_r AS (SELECT CASE WHEN sum({noise} * (n - 1)) > 0
            THEN greatest(sum((y - n * p) * (y - n * p) - {noise}) / sum({noise} * (n - 1)), 1e-9) ELSE 1.0 END AS rho FROM {source}),
          {name} AS (SELECT s.*, least(greatest(1 / rho - 1, {url_filter.WEAKEST}), {url_filter.STRONGEST}) AS m,
            (p * least(greatest(1 / rho - 1, {url_filter.WEAKEST}), {url_filter.STRONGEST}) + y)
            / (least(greatest(1 / rho - 1, {url_filter.WEAKEST}), {url_filter.STRONGEST}) + n) AS q FROM {source} s, {name}_r)"""

    return f"""
WITH rules(rule, rhost, rpath, what) AS (VALUES {rules}),
p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT host, greatest(1 - quality, toxic) AS bad FROM p JOIN labels l ON l.doc_id = p.page_id WHERE host <> ''),
t AS (SELECT host, string_split(host, '.') AS parts, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS y FROM o WHERE bad IS NOT NULL GROUP BY host
      UNION ALL SELECT DISTINCT host, string_split(host, '.'), 0, 0 FROM p WHERE host <> '' AND host NOT IN (SELECT host FROM o WHERE bad IS NOT NULL)),
h AS (SELECT host, n, y, len(parts) AS k, array_to_string(parts[-2:], '.') IN ({suffixes}) AS two,
        array_to_string(parts[-1:], '.') AS s1, array_to_string(parts[-2:], '.') AS s2, array_to_string(parts[-3:], '.') AS s3 FROM t),
every AS (SELECT host, n, y, CASE WHEN two THEN s2 ELSE s1 END AS suffix,
        CASE WHEN regexp_matches(host, '^[0-9.]+(:[0-9]+)?$') THEN host WHEN two THEN s3 ELSE s2 END AS domain FROM h),
hosts AS (SELECT * FROM every WHERE n > 0),
d0 AS (SELECT suffix, domain, sum(n) AS n, sum(y) AS y FROM hosts GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(y) AS y, (SELECT (sum(y) + 1) / (sum(n) + 2) FROM hosts) AS p FROM d0 GROUP BY suffix),
{level("s1", "s0")},
d1 AS (SELECT d0.*, s1.q AS p FROM d0 JOIN s1 USING (suffix)),
{level("d2", "d1")},
h1 AS (SELECT hosts.*, d2.q AS p FROM hosts JOIN d2 USING (suffix, domain)),
{level("h2", "h1")},
low AS (SELECT host, greatest(q - {url_filter.Z} * sqrt(q * (1 - q) / (m + n + 1)), 0) AS low FROM h2
        UNION ALL SELECT host, greatest(q - {url_filter.Z} * sqrt(q * (1 - q) / (m + 1)), 0) FROM (
          SELECT host, coalesce(d2.q, s1.q, (SELECT (sum(y) + 1) / (sum(n) + 2) FROM hosts)) AS q, (SELECT max(m) FROM h2) AS m
          FROM every LEFT JOIN d2 USING (suffix, domain) LEFT JOIN s1 ON s1.suffix = every.suffix WHERE every.n = 0)),
fits AS (SELECT page_id, arg_max(rule, strlen(rule)) AS rule, arg_max(what, strlen(rule)) AS what
         FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.what, CASE WHEN low > {url_filter.BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits f USING (page_id) LEFT JOIN low ON low.host = p.host
"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_duplicates(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.sha2(utf8(text_or_empty("text")), 256).alias("text_sha256")
    )


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS n FROM d)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(t) AS text_sha256 FROM r
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty("text").alias("text"))
    model = tokenizer_file("piece_bpe_32k.model")
    decoded = sentencepieces.decode(sentencepieces.encode(docs, model), model)
    return decoded.select(
        "doc_id",
        F.crc32("ids").alias("ids_crc32"),
        sentencepieces.token_count("ids").alias("n_ids"),
        F.crc32(utf8(F.col("decoded"))).alias("decoded_crc32"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(utf8(text)).alias("text_crc32"),
    )
    return sharding.shard(docs, F.col("size"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = labelled_by_crc(F.col("doc_id"), 4, 2)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held)
    return score_toxicity(docs, model).select(
        "doc_id",
        held.alias("held_out"),
        F.col("toxicity_score").alias("score"),
        F.col("toxic").cast("int").alias("predicted"),
        F.transform("toxic_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("licences", ",").alias("licences"),
        F.array_join("licence_sentences", ",").alias("sentences"),
        F.array_join("unmatched_sentences", ",").alias("unmatched"),
    )


def _op7_sql() -> str:
    """The same scan in DuckDB, from the same tables of sentences and rules."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    pairs = ", ".join(f"({quote(form)}, {quote(name)})" for name, some in licenses.SENTENCES.items() for form in some)
    words = "|".join(licenses.KEYWORDS)
    # Rules are applied one after another in nested queries, so that the text stays short.
    steps, source = [], "s0"
    for k, (licence, parts) in enumerate(licenses.RULES):
        pattern = quote("".join(f";{p};" for p in parts))
        steps.append(
            f"s{k + 1} AS (SELECT doc_id, replace(seq, {pattern}, '|') AS seq, "
            f"CASE WHEN contains(seq, {pattern}) AND NOT list_contains(got, {quote(licence)}) "
            f"THEN list_append(got, {quote(licence)}) ELSE got END AS got, ids FROM {source})"
        )
        source = f"s{k + 1}"
    plain = lambda x: f"trim(regexp_replace({x}, '{licenses.ODD}', ' ', 'g'))"
    mark = lambda x: f"CASE WHEN {plain(x)} IN (SELECT form FROM known) THEN chr(2) ELSE '' END"
    return f"""
WITH known(form, name) AS (VALUES {pairs}),
folded AS (SELECT doc_id, row_number() OVER () AS row_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(1) || chr(2), 'abcdefghijklmnopqrstuvwxyz  ') AS t FROM documents),
bare AS (SELECT doc_id, row_id, string_split(regexp_replace(regexp_replace(t, '{licenses.MARKS}', '\\1', 'g'), '{licenses.VERSION}', 'v \\1', 'g'), chr(10)) AS p FROM folded),
lines AS (SELECT doc_id, row_id, generate_subscripts(p, 1) AS i, unnest(p) AS l FROM bare),
ends AS (SELECT doc_id, row_id, i, l, string_split_regex(l, '{licenses.STOP}') AS f FROM lines),
soft AS (SELECT doc_id, row_id, i, {mark("f[1]")} || l || {mark("f[-1]")} AS l FROM ends),
joined AS (SELECT doc_id, row_id, string_agg(l, chr(10) ORDER BY i) AS t FROM soft GROUP BY ALL),
cut AS (SELECT doc_id, row_id, string_split(regexp_replace(regexp_replace(regexp_replace(t, '{licenses.ITEM}', chr(1) || '\\1', 'g'),
         '\\x02?{licenses.PARAGRAPH}', chr(1), 'g'), '{licenses.STOP}', chr(1), 'g'), chr(1)) AS p FROM joined),
whole AS (SELECT doc_id, row_id, generate_subscripts(p, 1) AS i, unnest(p) AS s FROM cut),
split AS (SELECT doc_id, row_id, i, CASE WHEN {plain("s")} IN (SELECT form FROM known) THEN [s] ELSE string_split(s, chr(2)) END AS p FROM whole),
parts AS (SELECT doc_id, row_id, i, generate_subscripts(p, 1) AS k, unnest(p) AS s FROM split),
named AS (SELECT c.doc_id, c.row_id, c.i, c.k, coalesce(n.name, CASE WHEN regexp_matches({plain("c.s")}, '\\b({words})\\b') THEN 'UNKNOWN' END) AS name
          FROM parts c LEFT JOIN known n ON {plain("c.s")} = n.form),
lists AS (SELECT doc_id, row_id, list(name ORDER BY i, k) FILTER (WHERE name IS NOT NULL) AS ids FROM named GROUP BY ALL),
s0 AS (SELECT doc_id, ';' || array_to_string(coalesce(ids, []::VARCHAR[]), ';;') || ';' AS seq, []::VARCHAR[] AS got, coalesce(ids, []::VARCHAR[]) AS ids FROM lists),
{", ".join(steps)}
SELECT doc_id, array_to_string(got, ',') AS licences, array_to_string(ids, ',') AS sentences,
       array_to_string(list_filter(string_split_regex(seq, '[;|]+'), lambda x: x <> ''), ',') AS unmatched
FROM {source}
"""


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = labelled_by_crc(F.col("doc_id"), 5, 0)
    model = fit_quality(docs, table(spark, sf_dir, "labels"), ~held)
    return score_quality(docs, model).select(
        "doc_id",
        held.alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_ok").cast("int").alias("predicted"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, F.col("id") % 50 == 0)


OP10_SQL = """
WITH fine AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
           FROM fine q JOIN fine c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_exact_dedup, op3_simhash, op4_sentencepiece, op5_histogram_shards,
        op6_toxic_spans, op7_license_scan, op8_pack, op9_quality, op10_topk,
    )
}
ORACLES = {"op1_url_filter": _op1_sql(), "op2_exact_dedup": OP2_SQL, "op7_license_scan": _op7_sql(), "op10_topk": OP10_SQL}
