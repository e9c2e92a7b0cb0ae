"""The registered queries of this subpackage and their SQL. Each applies its operator to the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.catalog.common import Registry, table
from seriesprep.llm import class_lm, decontaminate, exact_dedup, jaccard_join, mixing, quality, secret_scan, suffix_dedup, token_align, toxicity, url_filter, vector_codes, warc

registry = Registry()

# fixed values: the domain rules of the URL query
URL_RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)

URL_SQL = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM parts),
canon AS (
  SELECT *, regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '') || coalesce('?' || nullif(array_to_string(list_sort(
    list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') AS canonical
  FROM split),
listed AS (SELECT canonical FROM canon WHERE instr(url, '://') > 0 GROUP BY 1 HAVING count(*) > 1),
rules(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT url, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS rverdict
  FROM (SELECT DISTINCT url, host, path FROM split) s JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1)
SELECT c.page_id, coalesce(c.host, '') AS host, coalesce(c.path, '') AS path, b.rule,
  coalesce(b.rverdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.canonical IS NOT NULL AS listed
FROM canon c LEFT JOIN best b ON c.url = b.url LEFT JOIN listed l ON c.canonical = l.canonical
"""


@registry("op1_url_filter", URL_SQL)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the domain rules and by the list of canonical URLs that were captured more than once."""
    pages = table(spark, folder, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, rules, url_filter.recaptured(pages))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@registry("op3_exact_dedup", EXACT_SQL)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's group of equal texts and whether it stays."""
    return exact_dedup.exact_groups(table(spark, folder, "documents")).drop("same_id")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS code, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(code, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


@registry("op4_warc", WARC_SQL)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to an archive and read back from it."""
    records = warc.archive_pages(table(spark, folder, "pages"))
    return records.select(
        warc.id_in(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.id_in(F.col("refers_to")).alias("refers_to"))


def _secret_sql() -> str:
    """Spans in SQL: positions are sums of the lengths of matches and of the pieces between them."""
    either = "".join
    word = lambda w: either(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    names = "|".join([word("password"), word("passwd"), word("secret"), word("token"), word("api") + "_?" + word("key")])
    rules = {
        "assign": (f"({names})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24),
    } | {r.kind: (r.pattern, 0, 1) for r in secret_scan.MORE_RULES}
    parts = []
    for rank, (kind, (pattern, group, least)) in enumerate(rules.items()):
        parts.append(
            f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, s AS start, s + length(m) AS \"end\" FROM (SELECT doc_id, m, j, "
            f"CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s "
            f"FROM (SELECT doc_id, gaps, found, unnest(found) AS m, unnest(judged) AS j, generate_subscripts(found, 1) AS i FROM ("
            f"SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found, "
            f"regexp_extract_all(t, '{pattern}', {group}) AS judged FROM d WHERE regexp_matches(t, '{pattern}')))) WHERE length(j) >= {least}")
    joined = "string_agg(kind || ':' || start || ':' || \"end\", ',' ORDER BY start, rank{f})"
    base = "coalesce(string_agg(kind || ':' || start || ':' || \"end\", ',' ORDER BY start, rank) FILTER (rank < 3), '')"
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS (" + " UNION ALL ".join(parts) + "), "
        f"g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h, "
        f"{base} AS base, {joined.format(f='')} AS spans FROM s GROUP BY 1) "
        "SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, "
        "coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)")


@registry("op6_secret_scan", _secret_sql())
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in every document, each distinct text scanned once."""
    _, findings = secret_scan.scan(table(spark, folder, "documents"))
    base = tuple(r.kind for r in secret_scan.BASE_RULES)
    every = tuple(r.kind for r in secret_scan.RULES)
    count = lambda kind: F.size(F.element_at(F.col("found"), every.index(kind) + 1)["spans"]).cast("long")
    return findings.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.joined_spans(F.col("found"), base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("found"), every).alias("spans"))


@registry("op7_quality")
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document: posterior of its weak labels, probability by the scorer, and the decision."""
    return quality.classify(table(spark, folder, "documents")).drop("_key")


LEAK_SQL = r"""
WITH texts AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM texts),
s AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) >= 5),
n AS (SELECT id, count(*) AS n FROM s WHERE kind = 1 GROUP BY 1)
SELECT d.id AS doc_id, b.id AS item_id, max(n.n) AS n_item, count(*) AS n_shared, count(*) / max(n.n) AS containment
FROM s d JOIN s b ON d.s = b.s AND d.kind = 0 AND b.kind = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * max(n.n)
"""


@registry("op8_decontaminate", LEAK_SQL)
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of document and benchmark item with four fifths or more of the item's shingles in the document."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("_key")


@registry("op10_mixing")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Domain posteriors and rate of every document."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("_key")


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
f AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, p.b FROM r JOIN p ON r.seen = p.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m AS component_id FROM s JOIN (SELECT node, min(seen) AS m FROM r GROUP BY 1) ON node = doc_id
"""


@registry("op2_jaccard_join", JACCARD_SQL)
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle count and component of every document."""
    return jaccard_join.similar_groups(table(spark, folder, "documents")).drop("_key")


@registry("op5_class_lm")
def op5_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by the class model trained on those not held out."""
    return class_lm.score_corpus(table(spark, folder, "documents"))


@registry("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that 50-byte strings of documents with smaller ids cover."""
    return suffix_dedup.repeated_bytes(table(spark, folder, "documents")).drop("spans")


@registry("op11_token_align")
def op11_token_align(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of the alignment of two tokenizers over every document."""
    return token_align.align_corpus(table(spark, folder, "documents"))[0]


@registry("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, the decision at one half, and that at the threshold of its language."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _codes_sql() -> str:
    """Every round written out; whole numbers in doubles, which are exact here."""
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p))""",
        f"""b0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, p, min({entries} * (list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)) + e) AS best
  FROM parts JOIN b{k} USING (p) GROUP BY vec_id, p)""")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT p, e, i, CAST(sum(y) AS BIGINT) AS s, count(*) AS n FROM (
  SELECT p, CAST(best AS BIGINT) % {entries} AS e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{k} JOIN parts USING (vec_id, p)) GROUP BY p, e, i)""")
            steps.append(f"""m{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM s{k} GROUP BY p, e)""")
            steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(best AS BIGINT) % {entries}), '' ORDER BY p) AS code,
  CAST(sum(CAST(best AS BIGINT) // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) AS d FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


@registry("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector, and the digest of the codebooks."""
    coded, books = vector_codes.compress(table(spark, folder, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(books.digest()))
