"""Content: digests, checksums, get, put."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.functions import text
from trovelake.operators import transfer
from trovelake.registry.book import query
from trovelake.registry.request_sets import bare_requests
from trovelake.sources.contents import digested
from trovelake.sources.tables import Tables, document_catalogue


@query("src03_content_md5", """
SELECT coll_path AS collection, data_name AS data_object, md5(content) AS md5,
  strlen(content)::BIGINT AS size, TRUE AS is_utf8 FROM contents""")
def content_md5(spark, sf):
    return digested(document_catalogue(spark, sf).contents).select(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"), "md5",
        "size", "is_utf8")


def _labelled_uploads(spark, sf):
    """Toxic documents are written again in upper case; pages are new."""
    t = Tables(spark, sf)
    toxic = t.documents.join(t.labels.where("toxic = 1"), "doc_id")
    again = toxic.select(
        F.concat_ws("/", F.lit(""), F.lit("docs"), "source", "lang").alias("coll_path"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("data_name"),
        F.encode(F.concat("text", F.lit("!")), "UTF-8").alias("content"))
    pages = t.pages.select(
        F.lit("/docs/pages").alias("coll_path"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html"))
        .alias("data_name"), F.encode("html", "UTF-8").alias("content"))
    return again.unionByName(pages)


UPLOADED = """
SELECT coll_path AS collection, data_name AS data_object, md5(content) AS md5 FROM contents
WHERE data_id - 5000000000 NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT '/docs/' || source || '/' || lang, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt',
  md5(text || '!') FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
UNION ALL SELECT '/docs/pages', 'page_' || CAST(page_id AS VARCHAR) || '.html', md5(html)
  FROM pages"""


@query("snk03_upsert", UPLOADED)
def upsert(spark, sf):
    contents = document_catalogue(spark, sf).contents
    after = transfer.upserted(contents, _labelled_uploads(spark, sf))
    return after.select(F.col("coll_path").alias("collection"),
                        F.col("data_name").alias("data_object"), F.md5("content").alias("md5"))


@query("snk03_upsert_twice", UPLOADED)
def upsert_twice(spark, sf):
    new = _labelled_uploads(spark, sf)
    once = transfer.upserted(document_catalogue(spark, sf).contents, new)
    return transfer.upserted(once, new).select(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"),
        F.md5("content").alias("md5"))


@query("snk04_write_verified", """
SELECT data_id, COALESCE(md5(content) = checksum, FALSE) AS verified FROM contents""")
def write_verified(spark, sf):
    return transfer.verified_after(document_catalogue(spark, sf).contents).select(
        "data_id", "verified")


@query("act11_checksum_calculate", """
SELECT data_id, COALESCE(checksum, md5(content)) AS checksum FROM contents""")
def checksum_calculate(spark, sf):
    return transfer.calculated(document_catalogue(spark, sf).contents).select(
        "data_id", "checksum")


@query("act11_checksum_forced", """
SELECT data_id, md5(content) AS checksum FROM contents""")
def checksum_forced(spark, sf):
    return transfer.calculated(document_catalogue(spark, sf).contents, force=True).select(
        "data_id", "checksum")


def _document_requests(spark, sf, operation):
    rows = document_catalogue(spark, sf).contents
    return bare_requests(rows, F.col("data_id"), F.struct(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object")),
        operation)


@query("act11_checksum_requests", """
SELECT data_id, COALESCE(checksum, md5(content)) AS checksum FROM contents""")
def checksum_requests(spark, sf):
    """One request per document; the sum is recorded on the replicas."""
    changed, _ = transfer.checksum(document_catalogue(spark, sf),
                                   _document_requests(spark, sf, "checksum"))
    return changed.replicas.select("data_id", "checksum")


@query("act12_checksum_verify", """
SELECT data_id AS request_id, CASE WHEN checksum = md5(content) THEN NULL ELSE -314000 END AS code
FROM contents""")
def checksum_verify(spark, sf):
    asked = _document_requests(spark, sf, "checksum")
    asked = asked.withColumn("arguments", F.col("arguments").withField("verify", F.lit(True)))
    _, responses = transfer.checksum(document_catalogue(spark, sf), asked)
    return responses.select("request_id", F.col("error.code").alias("code"))


@query("act13_get", """
SELECT data_id AS request_id, md5(content) AS data_md5, strlen(content)::BIGINT AS data_bytes
FROM contents""")
def get(spark, sf):
    """Documents with their whole text under ``data``."""
    responses = transfer.get(document_catalogue(spark, sf), _document_requests(spark, sf, "get"))
    data = F.try_variant_get(F.try_parse_json("single"), "$.data", "string")
    return responses.select("request_id", F.md5(F.encode(data, "UTF-8")).alias("data_md5"),
                            F.octet_length(data).cast("bigint").alias("data_bytes"))


@query("act14_get_integrity", """
SELECT data_id, md5(content) = checksum AS checksum_ok FROM contents""")
def get_integrity(spark, sf):
    return transfer.verified(document_catalogue(spark, sf).contents).select(
        "data_id", "checksum_ok")


@query("act15_get_save", """
SELECT data_id AS request_id, './' || data_name AS local_path, md5(content) AS md5
FROM contents""")
def get_save(spark, sf):
    found = transfer.fetched(document_catalogue(spark, sf), _document_requests(spark, sf, "get"))
    return found.select("request_id", "local_path", F.md5("content").alias("md5"))


def _put_requests(spark, sf):
    """Every document is put from a local file, with the sum on record."""
    rows = document_catalogue(spark, sf).contents
    asked = bare_requests(rows, F.col("data_id"), F.struct(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"),
        F.lit("/local").alias("directory"), F.col("checksum").alias("checksum")), "put")
    files = rows.select(F.concat(F.lit("/local/"), "data_name").alias("local_path"), "content")
    return asked, files


@query("act16_put_verify", """
SELECT data_id AS request_id, CASE WHEN checksum <> md5(content) THEN -314000 END AS code
FROM contents""")
def put_verify(spark, sf):
    asked, files = _put_requests(spark, sf)
    asked = asked.withColumn("arguments", F.col("arguments").withField("verify", F.lit(True)))
    return transfer.uploads(asked, files).select(
        "request_id", F.col("error.code").alias("code"))


@query("act16_put", """
SELECT data_id, strlen(content)::BIGINT AS size, NULL AS checksum, '1' AS status FROM contents""")
def put(spark, sf):
    """Plain put records no sum."""
    asked, files = _put_requests(spark, sf)
    changed, _ = transfer.put(document_catalogue(spark, sf), asked, files)
    return changed.replicas.select("data_id", "size", "checksum", "status")


@query("act17_write", """
SELECT data_id, CASE WHEN checksum <> md5(content) THEN checksum ELSE md5(content) END AS checksum
FROM contents""")
def write(spark, sf):
    """Write checks afterwards; a document with a wrong sum stays as it was."""
    asked, files = _put_requests(spark, sf)
    changed, _ = transfer.write(document_catalogue(spark, sf), asked, files)
    return changed.replicas.select("data_id", "checksum")


@query("fn25_md5", "SELECT doc_id, md5(text) AS md5 FROM documents")
def md5(spark, sf):
    return Tables(spark, sf).documents.select(
        "doc_id", text.content_md5(F.encode("text", "UTF-8")).alias("md5"))


@query("fn09_utf8", "SELECT page_id, TRUE AS plain, FALSE AS latin1 FROM pages")
def utf8(spark, sf):
    """UTF-8 pages are UTF-8; with a Latin-1 letter appended they are not."""
    latin = F.concat(F.encode("html", "UTF-8"), F.unhex(F.lit("E9")))
    return Tables(spark, sf).pages.select(
        "page_id", text.maybe_utf8(F.encode("html", "UTF-8")).alias("plain"),
        text.maybe_utf8(latin).alias("latin1"))


@query("fn10_to_utf8", """
SELECT doc_id, md5(text) AS kept, md5(source || chr(233)) AS converted FROM documents""")
def to_utf8(spark, sf):
    latin = F.concat(F.encode("source", "UTF-8"), F.unhex(F.lit("E9")))
    return Tables(spark, sf).documents.select(
        "doc_id", F.md5(F.encode(text.to_utf8(F.encode("text", "UTF-8")), "UTF-8")).alias("kept"),
        F.md5(F.encode(text.to_utf8(latin), "UTF-8")).alias("converted"))
