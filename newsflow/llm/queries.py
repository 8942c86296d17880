"""The registered queries of this package, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, fim, htmltext, langid, licenses, minhash, packing, secretscan, spotsigs, urlfilter, warc, whiten
from .common import table

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file(name: str) -> str:
    import public_tokenizers              # only the queries that need a tokenizer need the package
    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document: doc_id, item_id, the words it takes, edit distance and similarity."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = langid.fit(docs.where(third != 1).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), "text")
    return langid.predict(rows, model).drop("text")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.against_edits(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(TOKENIZER), with_ids=False)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict; values only as digests."""
    docs = table(spark, sf_dir, "documents")
    model = secretscan.train(secretscan.labelled_findings(docs), docs)
    found = secretscan.scan(docs, model)
    return found.select("doc_id", "start", "n_chars", F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_TOKENIZER))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whiten.apply(rows, whiten.fit(rows))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_url_filter, op3_language_id, op4_fingerprints, op5_license_scan, op6_near_dedup, op7_html_text,
                                   op8_warc, op9_packing, op10_secret_scan, op11_byte_bpe, op12_fill_in_middle, op13_whitening)}

_LOW = f"'{urlfilter.UPPER}', '{urlfilter.LOWER}'"

URL_SQL = f"""WITH rules(rhost, rpath, rverdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in urlfilter.RULES)}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), {_LOW}) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT k, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON starts_with(path, rpath) AND (host = rhost OR ends_with(host, '.' || rhost)) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{urlfilter.DEFAULT}') AS verdict FROM parts LEFT JOIN fits USING (k)"""

NEAR_SQL = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(id, c) AS (SELECT doc_id, doc_id FROM sets UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id),
named AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept FROM sets JOIN named ON id = doc_id"""

FIM_SQL = """WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
  ('0x' || substr(h, 17, 8))::BIGINT % 100 AS p, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS q FROM cut),
formed AS (SELECT doc_id, t, n::BIGINT AS n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain' WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(u[1:least(x, y)], '') AS a, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS z FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM formed"""

ORACLES = {"op2_url_filter": URL_SQL, "op5_license_scan": licenses.oracle(), "op6_near_dedup": NEAR_SQL, "op12_fill_in_middle": FIM_SQL}
