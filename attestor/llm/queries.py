"""The queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm import collocations, decontaminate, fill_in_middle, fingerprint, language_id, license_scan, line_dedup, mixing, ngram_join, sharding, token_counts, toxicity, url_filter
from attestor.llm.scratch import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """The remainder by which rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels.where(fold(5) != 0)))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (F.coalesce(fold(5), F.lit(-1)) == 0).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hits = F.col("hits")
    return decontaminate.scan(docs.select("doc_id", "text"), items).select(
        "doc_id", hits["n_words"].alias("n_words"), decontaminate.n_hit(hits).alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"), decontaminate.items_digest(hits).alias("items_sha256"),
        decontaminate.contaminated(hits).alias("contaminated"),
    )


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Learnt from the rows of ``docs`` that are not held out."""
    return language_id.fit(docs.where(fold(4) != 2))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (F.coalesce(fold(4), F.lit(-1)) == 2).alias("held_out"), "lang_pred", "score")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: Fixed by the query's contract: host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.range_sorted(mixing.mix(table(spark, sf_dir, "documents")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    keyed = sharding.keyed(docs, F.octet_length(text) + sharding.OVERHEAD, text, ["doc_id", "text"])
    slim = materialize(keyed.select("doc_id", F.crc32(text).alias("text_crc32"), "_size", "_k1", "_k2"), "shard-keys")
    placed = sharding.assign(slim, sharding.shard_plan(slim, 24))
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.find_repeated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed_lines")
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, fim = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("fim")
    return made.select(
        "doc_id", fim["n"].alias("n"), fim["form"].alias("form"), fim["prefix"].alias("prefix_chars"), fim["middle"].alias("middle_chars"),
        F.sha2(fim["output"], 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(fim["output"], fim["form"]), 256).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("licenses")
    base, starts = found["base"], F.transform(found["base"], lambda d: d["start"].cast("long"))
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", found["n_words"].alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        license_scan.labels(base).alias("base_labels"), license_scan.labels(base, found["found"]).alias("labels"), license_scan.score(found["found"], base).alias("score"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


#: Words by the pattern that decontamination takes, after A-Z is lower-cased.
WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, {WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
    FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dg AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n),
hit AS (SELECT dg.doc_id, dg.i, dg.n, bw.id FROM dg JOIN bw ON dg.n = bw.n AND dg.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""


OP9_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM d, unnest(range(1, greatest(1, len(w) - 4) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE c >= 0.8e0 * (a.n + b.n - c) - 1e-9),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x AS doc_id, min(y) AS other FROM r GROUP BY x),
e AS (SELECT x AS doc_id, count(*) AS links FROM l GROUP BY x),
f AS (SELECT w, min(doc_id) AS rep FROM d WHERE len(w) > 0 GROUP BY w)
SELECT d.doc_id, coalesce(rep, d.doc_id) AS rep_id, least(d.doc_id, coalesce(other, d.doc_id)) AS class_id, CAST(coalesce(links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN e ON e.doc_id = d.doc_id LEFT JOIN f ON f.w = d.w
"""

OP10_SQL = f"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
i AS (SELECT doc_id, i - 1 AS line, ls[i] AS text FROM t, unnest(range(1, len(ls) + 1)) u(i)),
w AS (SELECT doc_id, line, {WORDS} AS w FROM i),
s AS (SELECT DISTINCT doc_id, line, array_to_string(w[j : j + 4], ' ') AS g FROM w, unnest(range(1, greatest(1, len(w) - 4) + 1)) u(j) WHERE len(w) > 0),
n AS (SELECT doc_id, line, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id, a.line, b.doc_id AS d2, b.line AS l2, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.line < a.line) GROUP BY ALL),
m AS (SELECT DISTINCT p.doc_id, p.line FROM p JOIN n a ON a.doc_id = p.doc_id AND a.line = p.line JOIN n b ON b.doc_id = d2 AND b.line = l2 WHERE c >= 0.8e0 * (a.n + b.n - c) - 1e-9),
r AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed_lines FROM m GROUP BY doc_id)
SELECT t.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM t LEFT JOIN r ON r.doc_id = t.doc_id
"""


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
        ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM c
"""

OP12_SQL = r"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM s),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
    FROM w, unnest(range(1, 6)) x(m), unnest(range(1, len(w) - m + 2)) y(i) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE m > 1),
k AS (SELECT c.*, k, array_to_string(w[1 : k], ' ') AS p, array_to_string(w[k + 1 :], ' ') AS q FROM c, unnest(range(1, m)) z(k)),
z AS (SELECT k.lang, k.phrase, k.m, k.a, k, p.f AS l, q.f AS r, n, CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
    FROM k JOIN g p ON p.lang = k.lang AND p.phrase = k.p JOIN g q ON q.lang = k.lang AND q.phrase = k.q JOIN t ON t.lang = k.lang),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.m > b.m AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM u
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": OP2_SQL, "op9_ngram_jaccard_join": OP9_SQL, "op10_line_dedup": OP10_SQL,
        "op11_fill_in_middle": OP11_SQL, "op12_collocations": OP12_SQL,
    }
