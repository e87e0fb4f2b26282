"""Queries of the document pipeline over whole tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varak import rules
from varak.functions import geo, meta
from varak.functions import text as T
from varak.functions.udf import html_to_markdown, sentences
from varak.operators import assemble, catalog, dataset, figures, reconcile
from varak.sources import files
from varak.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _cat(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "doc_catalog")


def _skip(s: SparkSession, d: str) -> DataFrame:
    """Hashes that processing failed for: here those of the listing's entries without a public URL."""
    return table(s, d, "listing").where("md5 is not null and public_url is null").select("md5").distinct()


_SKIP = "(SELECT md5 FROM listing WHERE md5 IS NOT NULL AND public_url IS NULL)"
_TARGET, _NONDOC, _PDF = _in(rules.TARGET_LANGUAGES), _in(rules.NON_DOCUMENT_TYPES), _in(rules.PDF_TYPES)
_KEY = "array_to_string(list_sort(list_filter(list_transform(string_split(isbn, ','), lambda x: trim(x, ' ')), lambda x: x <> '')), ', ')"
_KEYED = f"keyed AS (SELECT *, {_KEY} AS isbn_key FROM doc_catalog WHERE isbn IS NOT NULL)"

# counts


@query("SELECT language, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM doc_catalog), 2) AS percent FROM doc_catalog GROUP BY language")
def language_distribution(s, d):
    return catalog.distribution(_cat(s, d), "language")


@query("SELECT mime_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM doc_catalog), 2) AS percent FROM doc_catalog WHERE content_url IS NULL GROUP BY mime_type")
def mime_distribution_unprocessed(s, d):
    return catalog.distribution(_cat(s, d), "mime_type", F.col("content_url").isNull())


@query("SELECT count(*) AS n FROM doc_catalog WHERE mime_type = 'application/pdf' AND is_full AND language = 'tt-Cyrl' AND content_url IS NOT NULL")
def filtered_count(s, d):
    return _cat(s, d).where("mime_type = 'application/pdf' and is_full and language = 'tt-Cyrl' and content_url is not null").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n_texts, count(*) FILTER (WHERE coalesce(t.text, '') = '') AS n_empty, count(*) FILTER (WHERE c.md5 IS NULL) AS n_unmatched
FROM documents t LEFT JOIN doc_catalog c ON t.md5 = c.md5""")
def run_counters(s, d):
    return dataset.counters(table(s, d, "documents"), _cat(s, d))


# selections and queues


@query("SELECT md5, mime_type FROM (SELECT md5, mime_type FROM doc_catalog WHERE is_full ORDER BY md5 LIMIT 50 OFFSET 20)")
def catalog_page(s, d):
    return catalog.find(_cat(s, d).select("md5", "mime_type", "is_full"), F.col("is_full"), 50, 20).select("md5", "mime_type")


@query("SELECT md5, ya_resource_id, ya_path, upstream_meta_url FROM doc_catalog")
def catalog_projection(s, d):
    return _cat(s, d).select("md5", "ya_resource_id", "ya_path", "upstream_meta_url")


@query("SELECT md5, title FROM doc_catalog WHERE md5 IN (SELECT md5 FROM listing WHERE starts_with(file_path, '/corpus/limited/'))")
def documents_by_path(s, d):
    return catalog.select_documents(_cat(s, d), path="/corpus/limited", listing=table(s, d, "listing")).select("md5", "title")


@query("SELECT md5, regexp_matches(lower(md5), '^[0-9a-f]{32}$') AS valid FROM (SELECT md5 FROM doc_catalog UNION ALL SELECT upper(public_key) FROM listing WHERE public_key IS NOT NULL)")
def md5_validation(s, d):
    rows = _cat(s, d).select("md5").unionByName(table(s, d, "listing").where("public_key is not null").select(F.upper("public_key").alias("md5")))
    return rows.select("md5", catalog.valid_md5(F.col("md5")).alias("valid"))


@query(f"""SELECT md5, 'nontatar/' || array_to_string(list_sort(string_split(language, ', ')), '-') AS destination FROM doc_catalog WHERE language NOT IN {_TARGET}""")
def plan_nontarget_language(s, d):
    return _cat(s, d).where(catalog.nontarget(F.col("language"))).select("md5", catalog.nontarget_place(F.col("language")).alias("destination"))


@query(f"SELECT md5, mime_type FROM doc_catalog WHERE mime_type IN {_NONDOC} OR ends_with(ya_path, '.eaf') OR ends_with(ya_path, '.musx') OR ends_with(ya_path, '.bin')")
def plan_nontextual(s, d):
    suffixes = (*rules.NON_DOCUMENT_SUFFIXES, ".bin")
    return _cat(s, d).where(catalog.nontextual(F.col("mime_type"), F.col("ya_path"), suffixes=suffixes)).select("md5", "mime_type")


def _path_case() -> str:
    arms = "".join(f" WHEN {'starts_with' if whole else 'contains'}(file_path, '{p}') AND (" + " OR ".join(f"ends_with(file_path, '{e}')" for e in ends) + f") THEN '{p}'" for p, whole, ends in rules.PATH_SKIPS)
    return f"CASE{arms} END"


@query(f"""SELECT file_path, mime_type, {_path_case()} AS rule, coalesce(mime_type IN {_NONDOC}, false)
  AND NOT coalesce((mime_type = 'application/octet-stream' AND ends_with(file_path, '.pdf')) OR (mime_type = 'text/html' AND (ends_with(file_path, '.txt') OR ends_with(file_path, '.doc'))), false) AS skip
FROM listing""")
def path_skip_rules(s, d):
    rows = table(s, d, "listing")
    return rows.select("file_path", "mime_type", catalog.skip_by_path(F.col("file_path")).alias("rule"), catalog.skip_by_type(F.col("mime_type"), F.col("file_path"))["skip"].alias("skip"))


@query(f"SELECT md5 FROM doc_catalog WHERE content_url IS NULL AND mime_type IN {_in(rules.TEXT_TYPES)} AND mime_type <> 'text/csv' AND NOT ends_with(ya_path, '.csv')")
def nonpdf_work_queue(s, d):
    return catalog.nonpdf_queue(_cat(s, d)).select("md5")


@query(f"SELECT md5 FROM doc_catalog WHERE content_url IS NULL AND mime_type = 'application/pdf' AND language = 'tt-Cyrl' AND is_full AND md5 NOT IN {_SKIP}")
def pdf_work_queue(s, d):
    return catalog.pdf_queue(_cat(s, d), _skip(s, d)).select("md5")


@query(f"SELECT md5, CASE WHEN content_url IS NOT NULL THEN 'text' WHEN mime_type = 'application/pdf' THEN 'slice' ELSE 'skip' END AS route FROM doc_catalog WHERE meta IS NULL AND (content_url IS NOT NULL OR mime_type = 'application/pdf') AND md5 NOT IN {_SKIP}")
def meta_work_queue(s, d):
    q = catalog.meta_queue(_cat(s, d), _skip(s, d))
    return q.select("md5", catalog.meta_route(q).alias("route"))


@query(f"SELECT md5 FROM doc_catalog WHERE meta IS NULL OR language IN {_in(rules.SECOND_LANGUAGES)}")
def upload_queue(s, d):
    return catalog.upload_queue(_cat(s, d)).select("md5")


@query("SELECT md5 FROM doc_catalog WHERE mime_type = 'application/pdf' AND language = 'tt-Cyrl' AND is_full")
def layout_queue(s, d):
    return catalog.layout_queue(_cat(s, d)).select("md5")


@query(f"""SELECT md5, CASE WHEN is_full IS NOT TRUE THEN 'not full' WHEN sharing_restricted THEN 'sharing restricted' WHEN coalesce(isbn, '') <> '' THEN NULL
  WHEN contains(ya_path, 'архив') AND contains(ya_path, 'закон') AND ends_with(ya_path, '.pdf') THEN 'legal doc' END AS reason
FROM doc_catalog WHERE lib IS NULL AND language IN {_TARGET} AND content_url IS NOT NULL""")
def library_early_skip(s, d):
    return catalog.library_candidates(_cat(s, d)).select("md5", "reason")


@query("SELECT md5 FROM doc_catalog WHERE sharing_restricted AND (NOT starts_with(ya_public_url, 'enc:') OR NOT starts_with(document_url, 'enc:'))")
def unencrypted_links(s, d):
    return catalog.unencrypted(_cat(s, d)).select("md5")


# duplicates and reconciliation


@query(f"WITH {_KEYED} SELECT isbn_key, count(*) AS n_documents FROM keyed WHERE isbn_key <> '' GROUP BY isbn_key HAVING count(*) > 1")
def isbn_duplicate_groups(s, d):
    return reconcile.duplicate_groups(_cat(s, d))


_SURVIVORS = f"""{_KEYED},
flags AS (SELECT isbn_key, md5, coalesce(is_full, false) AS a, coalesce(is_full, false) AND coalesce(mime_type IN {_PDF}, false) AS b,
  coalesce(is_full, false) AND coalesce(mime_type IN {_PDF}, false) AND coalesce(content_url <> '', false) AS c,
  coalesce(CAST(page_count AS VARCHAR), '?') || '-' || coalesce(mime_type, '?') || '-' || CAST(coalesce(is_full, false) AS VARCHAR) AS shape,
  row_number() OVER (PARTITION BY isbn_key ORDER BY coalesce(ya_public_url, ''), md5) AS place FROM keyed WHERE isbn_key <> ''),
ruled AS (SELECT *, CASE WHEN sum(a::INT) OVER g = 1 THEN 'one_full' WHEN sum(b::INT) OVER g = 1 THEN 'one_full_pdf' WHEN sum(c::INT) OVER g = 1 THEN 'one_extracted_pdf'
  WHEN min(shape) OVER g = max(shape) OVER g THEN 'all_alike' ELSE 'needs_review' END AS rule, count(*) OVER g AS n FROM flags WINDOW g AS (PARTITION BY isbn_key)),
survivors AS (SELECT isbn_key, md5, rule, CASE rule WHEN 'one_full' THEN a WHEN 'one_full_pdf' THEN b WHEN 'one_extracted_pdf' THEN c WHEN 'all_alike' THEN place = 1 END AS keep FROM ruled WHERE n > 1)"""


@query(f"WITH {_SURVIVORS} SELECT * FROM survivors")
def isbn_survivors(s, d):
    return reconcile.isbn_survivors(_cat(s, d))


_PLAN = f"""{_SURVIVORS},
parts AS (SELECT md5, 'nontatar/' || array_to_string(list_sort(string_split(language, ', ')), '-') AS destination, 1 AS rank FROM doc_catalog WHERE language NOT IN {_TARGET}
  UNION ALL SELECT md5, 'nontextual', 2 FROM doc_catalog WHERE mime_type IN {_NONDOC} OR ends_with(ya_path, '.eaf') OR ends_with(ya_path, '.musx')
  UNION ALL SELECT md5, 'duplicated_isbn/' || isbn_key, 3 FROM survivors WHERE NOT keep),
plan AS (SELECT md5, arg_max(destination, rank) AS destination FROM parts GROUP BY md5)"""


@query(f"WITH {_PLAN} SELECT * FROM plan")
def wiping_plan(s, d):
    return reconcile.wiping_plan(_cat(s, d))


@query(f"""WITH {_PLAN},
files AS (SELECT DISTINCT ON (md5, path, resource_id) * FROM (SELECT *, regexp_replace(file_path, '^disk:', '') AS path FROM listing WHERE entry_type = 'file' AND md5 IS NOT NULL)),
firsts AS (SELECT md5, resource_id AS first_id FROM (SELECT *, row_number() OVER (PARTITION BY md5 ORDER BY coalesce(listed_at, TIMESTAMP '9999-01-01'), path, coalesce(resource_id, '')) AS k
  FROM (SELECT *, regexp_replace(file_path, '^disk:', '') AS path FROM listing WHERE entry_type = 'file' AND md5 IS NOT NULL)) WHERE k = 1)
SELECT f.md5, f.path, f.resource_id, CASE WHEN p.destination IS NOT NULL THEN 'move:' || p.destination WHEN {_path_case().replace('file_path', 'f.path')} IS NOT NULL THEN 'skip'
  WHEN coalesce(f.mime_type IN {_NONDOC}, false) THEN 'nontextual'
  WHEN NOT coalesce(f.resource_id = CASE WHEN c.md5 IS NOT NULL THEN c.ya_resource_id ELSE x.first_id END, false) THEN 'remove_duplicate'
  WHEN coalesce(c.ya_path = f.path, false) THEN 'unchanged' ELSE 'upsert' END AS action
FROM files f JOIN firsts x ON f.md5 = x.md5 LEFT JOIN doc_catalog c ON f.md5 = c.md5 LEFT JOIN plan p ON f.md5 = p.md5""")
def listing_actions(s, d):
    c = _cat(s, d)
    return reconcile.listing_actions(table(s, d, "listing"), c, reconcile.wiping_plan(c))


_KEYS = "keys AS (SELECT DISTINCT md5 || CASE WHEN ends_with(file_path, '.pdf') THEN '.zip' ELSE '-meta.zip' END AS obj_key FROM listing WHERE md5 IS NOT NULL)"


def _keys(s, d) -> DataFrame:
    rows = table(s, d, "listing").where("md5 is not null")
    return rows.select(F.concat("md5", F.when(F.col("file_path").endswith(".pdf"), ".zip").otherwise("-meta.zip")).alias("obj_key")).distinct()


@query(f"""WITH {_PLAN}, {_KEYS}
SELECT obj_key, CAST(floor((row_number() OVER (ORDER BY obj_key) - 1) / 10) AS BIGINT) AS batch FROM keys WHERE obj_key[1:32] IN (SELECT md5 FROM plan)""")
def delete_key_batches(s, d):
    return reconcile.delete_batches(_keys(s, d), reconcile.wiping_plan(_cat(s, d)), 10)


@query(f"WITH {_KEYS} SELECT md5 FROM doc_catalog WHERE md5 || '.zip' NOT IN (SELECT obj_key FROM keys)")
def missing_artifacts(s, d):
    from varak.sources.sinks import missing

    return missing(_cat(s, d).select("md5", F.concat("md5", F.lit(".zip")).alias("obj_key")), _keys(s, d)).select("md5")


@query("""WITH disk AS (SELECT DISTINCT md5 FROM listing WHERE contains(file_path, '/scan/') AND md5 IS NOT NULL), db AS (SELECT md5 FROM doc_catalog WHERE sharing_restricted)
SELECT md5, 'missing_on_disk' AS problem FROM db WHERE md5 NOT IN (SELECT md5 FROM disk) UNION ALL SELECT md5, 'not_restricted_in_catalog' FROM disk WHERE md5 NOT IN (SELECT md5 FROM db)""")
def restricted_audit(s, d):
    return reconcile.restricted_audit(_cat(s, d), table(s, d, "listing"))


_LIMITED = """named AS (SELECT nfc_normalize(trim(file_name)) AS name, md5, contains(file_path, '/limited/') AS limited, row(coalesce(listed_at, TIMESTAMP '0001-01-01'), md5) AS last FROM listing WHERE entry_type = 'file' AND md5 IS NOT NULL AND file_name IS NOT NULL),
pairs AS (SELECT name, arg_max(md5, last) FILTER (WHERE limited) AS md5, arg_max(md5, last) FILTER (WHERE NOT limited) AS full_md5 FROM named GROUP BY name),
matches AS (SELECT * FROM pairs WHERE md5 IS NOT NULL AND full_md5 IS NOT NULL AND md5 <> full_md5)"""


@query(f"WITH {_LIMITED} SELECT * FROM matches")
def limited_full_match(s, d):
    return reconcile.limited_matches(table(s, d, "listing"))


@query(f"""WITH {_LIMITED}
SELECT 'copy' AS op, m.md5 || '.zip' AS source, m.full_md5 || '.zip' AS target FROM matches m JOIN doc_catalog c ON m.md5 = c.md5 WHERE c.upstream_meta_url IS NOT NULL
UNION ALL SELECT 'delete', m.md5 || '.zip', NULL FROM matches m""")
def metadata_migrations(s, d):
    upstream = _cat(s, d).where("upstream_meta_url is not null").select("md5", F.col("upstream_meta_url").alias("url"))
    return reconcile.migrations(reconcile.limited_matches(table(s, d, "listing")), upstream)


@query("""WITH fresh AS (SELECT md5, min(mime_type) AS mime_type, min(file_path) AS ya_path FROM listing WHERE entry_type = 'file' AND md5 IS NOT NULL GROUP BY md5)
SELECT coalesce(n.md5, o.md5) AS md5, coalesce(n.mime_type, o.mime_type) AS mime_type, coalesce(n.ya_path, o.ya_path) AS ya_path, o.title FROM doc_catalog o FULL JOIN fresh n ON o.md5 = n.md5""")
def catalog_upsert(s, d):
    fresh = table(s, d, "listing").where("entry_type = 'file' and md5 is not null").groupBy("md5").agg(F.min("mime_type").alias("mime_type"), F.min("file_path").alias("ya_path"))
    return reconcile.upsert(_cat(s, d).select("md5", "mime_type", "ya_path", "title"), fresh)


@query(f"WITH {_PLAN} SELECT md5 FROM doc_catalog WHERE md5 NOT IN (SELECT md5 FROM plan)")
def catalog_after_wiping(s, d):
    c = _cat(s, d)
    return reconcile.delete(c.select("md5"), reconcile.wiping_plan(c))


@query("""SELECT c.md5, CASE WHEN coalesce(p.url_ok, false) THEN 'keep' WHEN coalesce(p.path_ok, false) THEN 'republish' ELSE 'upload' END AS action
FROM doc_catalog c LEFT JOIN (SELECT md5, bool_or(public_url IS NOT NULL) AS url_ok, bool_or(file_path IS NOT NULL) AS path_ok FROM listing WHERE md5 IS NOT NULL GROUP BY md5) p ON c.md5 = p.md5""")
def link_actions(s, d):
    probes = table(s, d, "listing").where("md5 is not null").groupBy("md5").agg(F.bool_or(F.col("public_url").isNotNull()).alias("url_ok"), F.bool_or(F.col("file_path").isNotNull()).alias("path_ok"))
    return reconcile.link_actions(_cat(s, d), probes)


@query("""SELECT md5, path, 'moved' AS what FROM (SELECT md5, CASE WHEN contains(ya_path, '/limited/') THEN NULL ELSE '/corpus/filtered_out/nontextual/' || regexp_replace(ya_path, '^/corpus/', '') END AS path FROM doc_catalog WHERE ya_path IS NOT NULL)""")
def move_targets(s, d):
    rows = _cat(s, d).where("ya_path is not null")
    place = F.when(F.col("ya_path").contains(rules.LIMITED_MARK), "void").otherwise("nontextual")
    return rows.select("md5", reconcile.move_target(F.col("ya_path"), place).alias("path"), F.lit("moved").alias("what"))


@query("SELECT md5 FROM doc_catalog INTERSECT SELECT md5 FROM listing")
def listed_and_catalogued(s, d):
    return _cat(s, d).select("md5").intersect(table(s, d, "listing").select("md5"))


# text


_DASH = "regexp_replace({}, '(^|\\n)- ?', '\\1— ', 'g')"
_NORMAL = (
    "replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    + _DASH.format("regexp_replace(replace(regexp_replace(regexp_replace(content, '(?m)^xml version=''1\\.0'' encoding=''utf-8''\\?\\s*', '', 'g'), '(?s)dN=`?.*?</a>`?\\{=html\\}', '', 'g'), chr(45) || chr(10), ''), '(?m)^!\\[\\]\\(.*?\\)\\s*', '', 'g')")
    + ", '!\\[.*?\\]\\(.*?\\)', '', 'g'), '<img\\s+[^>]*src=\"[^\"]+\"[^>]*>', '', 'g'), '(?s)<table\\s+class=\"toc\">.*?</table>', '" + rules.TOC_MARK + "', 'g'), '_{11,}', '__________', 'g')"
    + ", '\\\\', '\\'), '\\_', '_'), '\\<', '<')"
)


@query(f"SELECT chunk_id, {_NORMAL} AS text FROM doc_chunks WHERE content IS NOT NULL")
def text_normalized(s, d):
    return table(s, d, "doc_chunks").where("content is not null").select("chunk_id", T.normalize(F.col("content")).alias("text"))


@query("SELECT chunk_id, trim(unnest(regexp_extract_all(chr(10) || content, '\\n(#{2,6}[ \\t]+[^\\n]+)', 1))) AS header FROM doc_chunks WHERE content IS NOT NULL")
def headers_extracted(s, d):
    return table(s, d, "doc_chunks").select("chunk_id", F.explode(T.headers(F.col("content"))).alias("header"))


@query("SELECT chunk_id, CAST(coalesce(list_max(list_transform(regexp_extract_all(content, '\\[\\^(\\d{1,9})\\]:', 1), lambda x: CAST(x AS INT))), 0) AS BIGINT) AS last_footnote FROM doc_chunks WHERE content IS NOT NULL")
def footnotes_max(s, d):
    return table(s, d, "doc_chunks").where("content is not null").select("chunk_id", T.max_footnote(F.col("content")).cast("bigint").alias("last_footnote"))


@query("SELECT md5, NOT (regexp_matches(ya_public_url, '^[A-Za-z][A-Za-z0-9+.-]*:') OR starts_with(ya_public_url, '//')) AS url_relative, NOT (regexp_matches(ya_path, '^[A-Za-z][A-Za-z0-9+.-]*:') OR starts_with(ya_path, '//')) AS path_relative FROM doc_catalog")
def relative_links(s, d):
    return _cat(s, d).select("md5", T.relative_url(F.col("ya_public_url")).alias("url_relative"), T.relative_url(F.col("ya_path")).alias("path_relative"))


@query("SELECT md5, CASE WHEN regexp_extract(ya_path, '(\\.[^./]+)$', 1) <> '' THEN regexp_extract(ya_path, '(\\.[^./]+)$', 1) ELSE CASE lower(trim(mime_type)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.EXTENSIONS.items()) + " END END AS extension FROM doc_catalog WHERE ya_path IS NOT NULL")
def file_extensions(s, d):
    return _cat(s, d).where("ya_path is not null").select("md5", T.extension(F.col("ya_path"), F.col("mime_type")).alias("extension"))


@query()
def chunk_sentences(s, d):
    return table(s, d, "doc_chunks").select("chunk_id", F.size(sentences(F.col("content"))).alias("n_sentences"))


@query()
def markdown_from_html(s, d):
    page = F.concat(F.lit("<html><body><h2>"), F.coalesce("source", F.lit("?")), F.lit('</h2><p>Text <a href="x.html">here</a></p><p>'), "text", F.lit("</p></body></html>"))
    return table(s, d, "documents").where("text is not null").select("doc_id", html_to_markdown(page).alias("markdown"))


# ordered chunks


_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY md5, start_page, end_page ORDER BY coalesce(extracted_at, TIMESTAMP '0001-01-01') DESC, chunk_id DESC) AS k
  FROM doc_chunks WHERE content IS NOT NULL AND start_page IS NOT NULL AND end_page IS NOT NULL) WHERE k = 1)"""


def _chunks(s, d) -> DataFrame:
    return assemble.latest(table(s, d, "doc_chunks"))


@query(f"""WITH {_LATEST} SELECT md5, start_page, end_page, CAST(greatest(1, coalesce(max(last) OVER (PARTITION BY md5 ORDER BY start_page, end_page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1) AS BIGINT) AS next_footnote
FROM (SELECT *, coalesce(list_max(list_transform(regexp_extract_all(content, '\\[\\^(\\d{{1,9}})\\]:', 1), lambda x: CAST(x AS INT))), 0) AS last FROM latest)""")
def next_footnote(s, d):
    return assemble.next_footnotes(_chunks(s, d)).withColumn("next_footnote", F.col("next_footnote").cast("bigint"))


@query(f"""WITH {_LATEST}, own AS (SELECT md5, start_page, end_page, list_transform(regexp_extract_all(chr(10) || content, '\\n(#{{2,6}}[ \\t]+[^\\n]+)', 1), lambda x: trim(x)) AS h FROM latest)
SELECT md5, start_page, end_page, coalesce(array_to_string(flatten(list(h) OVER (PARTITION BY md5 ORDER BY start_page, end_page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), chr(10)), '') AS hierarchy FROM own""")
def header_hierarchy(s, d):
    return assemble.header_hierarchy(_chunks(s, d))


_BLOCK = " OR ".join(f"regexp_matches(content, '{p}')" for p in rules.BLOCK_STARTS)
_GLUED = f"""{_LATEST},
tails AS (SELECT *, lag(right(content, 300)) OVER w AS tail, row_number() OVER w AS place FROM latest WINDOW w AS (PARTITION BY md5 ORDER BY start_page, end_page)),
glued AS (SELECT *, CASE WHEN place = 1 OR content = '' THEN '' WHEN {_BLOCK} OR regexp_matches(coalesce(tail, ''), '(^|[.!?…]["»”)]*)\\s*$') THEN chr(10) || chr(10) WHEN ends_with(tail, '-') THEN '' ELSE ' ' END AS glue FROM tails)"""


@query(f"WITH {_GLUED} SELECT md5, start_page, end_page, glue FROM glued")
def chunk_continuity(s, d):
    return assemble.glues(_chunks(s, d)).select("md5", "start_page", "end_page", "glue")


@query(f"""WITH {_GLUED} SELECT md5, string_agg(glue || CASE WHEN ends_with(t, chr(10)) THEN left(t, length(t) - 1) ELSE t END, '' ORDER BY start_page, end_page) AS text, count(*) AS n_chunks
FROM (SELECT *, CASE WHEN ends_with(content, '-') THEN left(content, length(content) - 1) ELSE content END AS t FROM glued) GROUP BY md5""")
def assembled_documents(s, d):
    return assemble.documents(_chunks(s, d)).withColumn("n_chunks", F.col("n_chunks").cast("bigint"))


@query(f"""WITH {_GLUED}, sized AS (SELECT *, floor((sum(length(content)) OVER (PARTITION BY md5 ORDER BY start_page, end_page) - length(content)) / 4000) AS part_no FROM glued)
SELECT md5, CAST(part_no AS INT) AS part_no, string_agg(glue || CASE WHEN ends_with(t, chr(10)) THEN left(t, length(t) - 1) ELSE t END, '' ORDER BY start_page, end_page) AS text
FROM (SELECT *, CASE WHEN ends_with(content, '-') THEN left(content, length(content) - 1) ELSE content END AS t FROM sized) GROUP BY md5, part_no""")
def document_parts(s, d):
    """Texts of records in parts of 4,000 characters or a little more."""
    return assemble.document_parts(_chunks(s, d), 4000).drop("n_chunks")


def _totals(s, d) -> DataFrame:
    return _cat(s, d).where("page_count > 0").select("md5", F.col("page_count").alias("n_pages"))


_FREE = """ranges AS (SELECT DISTINCT c.md5, start_page, end_page FROM doc_chunks c JOIN doc_catalog d ON c.md5 = d.md5 WHERE d.page_count > 0 AND start_page IS NOT NULL AND end_page IS NOT NULL),
pages AS (SELECT md5, unnest(range(page_count)) AS page FROM doc_catalog WHERE page_count > 0),
free AS (SELECT p.md5, p.page FROM pages p WHERE NOT EXISTS (SELECT 1 FROM ranges r WHERE r.md5 = p.md5 AND p.page BETWEEN r.start_page AND r.end_page))"""


def _ranges(s, d) -> DataFrame:
    return table(s, d, "doc_chunks").where("start_page is not null and end_page is not null").select("md5", "start_page", "end_page").distinct()


@query(f"""WITH {_FREE}, islands AS (SELECT md5, page, page - row_number() OVER (PARTITION BY md5 ORDER BY page) AS island FROM free),
placed AS (SELECT md5, page, island, floor((row_number() OVER (PARTITION BY md5, island ORDER BY page) - 1) / 5) AS part FROM islands)
SELECT md5, min(page) AS start_page, max(page) AS end_page FROM placed GROUP BY md5, island, part""")
def chunk_gaps(s, d):
    return assemble.gaps(_ranges(s, d), _totals(s, d)).select("md5", F.col("start_page").cast("bigint").alias("start_page"), F.col("end_page").cast("bigint").alias("end_page"))


@query(f"WITH {_FREE} SELECT md5, page FROM free")
def uncovered_pages(s, d):
    return assemble.uncovered_pages(_ranges(s, d), _totals(s, d)).select("md5", F.col("page").cast("bigint").alias("page"))


_GAPS = f"""{_FREE}, islands AS (SELECT md5, page, page - row_number() OVER (PARTITION BY md5 ORDER BY page) AS island FROM free),
placed AS (SELECT md5, page, island, floor((row_number() OVER (PARTITION BY md5, island ORDER BY page) - 1) / 5) AS part FROM islands),
gaps AS (SELECT md5, min(page) AS start_page, max(page) AS end_page FROM placed GROUP BY md5, island, part)"""


@query(f"""WITH {_GAPS}, turned AS (SELECT *, row_number() OVER (PARTITION BY md5 ORDER BY start_page DESC) AS k, lag(end_page) OVER w AS before, lead(start_page) OVER w AS next_start, lead(end_page) OVER w AS next_end FROM gaps WINDOW w AS (PARTITION BY md5 ORDER BY start_page))
SELECT md5, start_page, CASE WHEN k = 2 AND next_end - next_start + 1 < 5 AND end_page + 1 = next_start THEN next_end ELSE end_page END AS end_page
FROM turned WHERE NOT (k = 1 AND end_page - start_page + 1 < 5 AND coalesce(before + 1 = start_page, false))""")
def chunk_plan_merged(s, d):
    out = assemble.merged_tail(assemble.gaps(_ranges(s, d), _totals(s, d)))
    return out.select("md5", F.col("start_page").cast("bigint").alias("start_page"), F.col("end_page").cast("bigint").alias("end_page"))


@query("""WITH picked AS (SELECT md5, page, page - row_number() OVER (PARTITION BY md5 ORDER BY page) AS island FROM (SELECT md5, page_count, unnest(range(page_count)) AS page FROM doc_catalog WHERE page_count > 0) WHERE page < 5 OR page >= page_count - 5)
SELECT md5, min(page) AS start_page, max(page) AS end_page FROM picked GROUP BY md5, island""")
def page_islands(s, d):
    return assemble.page_islands(_totals(s, d)).select("md5", F.col("start_page").cast("bigint").alias("start_page"), F.col("end_page").cast("bigint").alias("end_page"))


# metadata

_BARE = r"regexp_replace(regexp_replace({}, '^\s*```[a-zA-Z]*\s*', ''), '\s*```\s*$', '')"
_LIST = "CASE WHEN coalesce(json_type({0}), 'NULL') = 'NULL' THEN NULL WHEN json_type({0}) = 'ARRAY' THEN CAST({0} AS JSON[]) ELSE [{0}] END"
_NAMES = "list_filter(list_transform({}, lambda x: CASE WHEN json_type(x) = 'OBJECT' THEN x->>'$.name' WHEN json_type(x) = 'VARCHAR' THEN x->>'$' END), lambda n: n IS NOT NULL)"
#: Records of every readable shape in SQL: fences and strings round them taken off, the Book of a graph taken out.
_META = f"""WITH a AS (SELECT md5, meta, publish_date AS old, page_count AS old_pages, TRY_CAST({_BARE.format('meta')} AS JSON) AS j FROM doc_catalog),
b AS (SELECT * REPLACE (CASE WHEN json_type(j) = 'VARCHAR' THEN TRY_CAST({_BARE.format("(j->>'$')")} AS JSON) ELSE j END AS j) FROM a),
c AS (SELECT *, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) WHEN json_type(j, '$."@graph"') = 'ARRAY' AND json_type(j, '$.name') IS NULL THEN CAST(json_extract(j, '$."@graph"') AS JSON[]) END AS g FROM b),
e AS (SELECT *, list_filter(g, lambda x: json_type(x) = 'OBJECT') AS o FROM c),
records AS (SELECT md5, meta, old, old_pages, CASE WHEN g IS NULL THEN CASE WHEN json_type(j) = 'OBJECT' THEN j END ELSE coalesce(list_filter(o, lambda x: x->>'$."@type"' = 'Book')[1], o[1]) END AS j FROM e)"""


@query(f"""{_META}, lists AS (SELECT *, {_LIST.format("json_extract(j, '$.author')")} AS authors, {_LIST.format("json_extract(j, '$.publisher')")} AS publishers FROM records WHERE j IS NOT NULL),
named AS (SELECT *, {_NAMES.format('publishers')} AS houses FROM lists)
SELECT md5, CASE WHEN len(houses) > 0 AND lower(array_to_string(houses, ', ')) <> 'unknown' THEN array_to_string(houses, ', ') END AS publisher,
  array_to_string(list_filter({_NAMES.format('authors')}, lambda n: lower(n) <> 'unknown'), ', ') AS author,
  CASE WHEN lower(j->>'$.name') <> 'unknown' THEN j->>'$.name' END AS title,
  array_to_string(list_sort(list_filter(list_transform(string_split(j->>'$.inLanguage', ','), lambda x: trim(x)), lambda x: x <> '')), ', ') AS language,
  CASE WHEN regexp_matches(trim(j->>'$.datePublished'), '^\\d{{4}}[\\d-]*$') THEN trim(j->>'$.datePublished')[1:4] ELSE old END AS publish_date,
  CAST(CASE WHEN abs(TRY_CAST(j->>'$.numberOfPages' AS INT) - old_pages) < 5 THEN TRY_CAST(j->>'$.numberOfPages' AS INT) ELSE old_pages END AS BIGINT) AS page_count FROM named""")
def meta_flattened(s, d):
    """Every readable record, flattened, whatever its shape; a field that it lacks is null."""
    rows = _cat(s, d).withColumn("b", meta.book(F.col("meta"))).where("b is not null")
    b, pages = F.col("b"), meta.page_count(F.col("b"), F.col("page_count")).cast("bigint")
    return rows.select("md5", meta.publisher(b).alias("publisher"), meta.author(b).alias("author"), meta.title(b).alias("title"), meta.language(b).alias("language"), meta.publish_date(b, F.col("publish_date")).alias("publish_date"), pages.alias("page_count"))


_ISBNS = r"list_transform(flatten(list_transform(isbns, lambda x: regexp_extract_all(regexp_replace(x->>'$', 'ISBN(-1[03])?:?', ' ', 'g'), '(?:97[89](?:[ -]?[0-9]){10}|[0-9](?:[ -]?[0-9]){8}[ -]?[0-9X])'))), lambda y: regexp_replace(y, '[ -]', '', 'g'))"


@query(f"""{_META}, lists AS (SELECT md5, j, {_LIST.format("json_extract(j, '$.genre')")} AS genres, {_LIST.format("json_extract(j, '$.contributor')")} AS helpers, {_LIST.format("json_extract(j, '$.isbn')")} AS isbns,
  {_LIST.format("json_extract(j, '$.additionalProperty')")} AS props FROM records WHERE meta IS NOT NULL),
valued AS (SELECT *, list_transform(list_filter(props, lambda p: json_type(p) = 'OBJECT' AND coalesce(upper(trim(p->>'$.name')) IN ('UDC', 'УДК'), false)),
  lambda p: CASE json_type(p, '$.value') WHEN 'ARRAY' THEN array_to_string(list_transform(CAST(json_extract(p, '$.value') AS JSON[]), lambda x: x->>'$'), ', ') WHEN 'OBJECT' THEN NULL ELSE p->>'$.value' END) AS v FROM lists),
udc AS (SELECT *, list_filter(v, lambda x: coalesce(lower(x) NOT IN ('unknown', 'неизвестно'), false)) AS u FROM valued)
SELECT md5, CASE WHEN genres IS NOT NULL THEN array_to_string(list_filter(list_transform(genres, lambda g: lower(g->>'$')), lambda g: g IS NOT NULL AND g <> 'unknown'), ', ') END AS genre,
  CASE WHEN helpers IS NOT NULL THEN len(list_filter(helpers, lambda x: json_type(x) = 'OBJECT' AND coalesce(x->>'$.role' = 'translator', false))) > 0 END AS translated,
  coalesce(array_to_string(list_sort(list_distinct({_ISBNS})), ', '), '') AS isbn,
  CASE WHEN len(u) = 1 THEN regexp_replace(trim(u[1]), '[ \\n]', '', 'g') END AS udc, j IS NULL AS unreadable FROM udc""")
def meta_columns(s, d):
    """The remaining columns of a record: genre, translation, ISBNs, classification, and whether it can be read."""
    rows = _cat(s, d).where("meta is not null").withColumn("b", meta.book(F.col("meta")))
    b = F.col("b")
    return rows.select("md5", meta.genre(b).alias("genre"), meta.translated(b).alias("translated"), meta.isbn(b).alias("isbn"), meta.classification(b, ("UDC", "УДК")).alias("udc"), b.isNull().alias("unreadable"))


@query()
def meta_serialised(s, d):
    """Readable records as JSON text in one shape, without what the shape has no place for."""
    return _cat(s, d).select("md5", F.to_json(meta.book(F.col("meta"))).alias("meta")).where("meta is not null")


@query("SELECT md5, lib->>'$.tags' AS tags FROM doc_catalog WHERE lib IS NOT NULL AND json_valid(lib)")
def supplied_metadata(s, d):
    rows = _cat(s, d).where("lib is not null").withColumn("m", meta.without_dropped_keys(F.col("lib"))).where("m is not null")
    return rows.select("md5", F.get_json_object("m", "$.tags").alias("tags"))


# figures and boxes

_FIG = """SELECT p_partkey, 'before <figure' || CASE WHEN p_partkey % 10 = 0 THEN '' ELSE ' data-bbox="[' || CAST(p_partkey % 300 AS VARCHAR) || ', ' || CAST(p_partkey % 200 AS VARCHAR) || ', ' || CAST(p_partkey % 300 + 100 AS VARCHAR) || ', ' || CAST(p_partkey % 200 + 150 AS VARCHAR) || ']"' END
  || ' data-page="' || CAST(p_partkey % 9 + 1 AS VARCHAR) || '"><figcaption>' || p_name || '</figcaption></figure> after' AS content FROM part"""


def _figure_texts(s, d) -> DataFrame:
    k = F.col("p_partkey")
    at = lambda x: x.cast("string")
    box = F.concat(F.lit(' data-bbox="['), at(k % 300), F.lit(", "), at(k % 200), F.lit(", "), at(k % 300 + 100), F.lit(", "), at(k % 200 + 150), F.lit(']"'))
    text = F.concat(F.lit("before <figure"), F.when(k % 10 == 0, "").otherwise(box), F.lit(' data-page="'), at(k % 9 + 1), F.lit('"><figcaption>'), "p_name", F.lit("</figcaption></figure> after"))
    return table(s, d, "part").select("p_partkey", text.alias("content"))


@query(f"""SELECT p_partkey, CAST(page AS BIGINT) AS page, CASE WHEN box = '' THEN NULL ELSE CAST(string_split(box, ', ')[1] AS DOUBLE) END AS y0, caption, CASE WHEN box = '' THEN 'no_box' ELSE 'ok' END AS status
FROM (SELECT p_partkey, regexp_extract(content, 'data-bbox="\\[([^"]*)\\]"', 1) AS box, CAST(regexp_extract(content, 'data-page="(\\d+)"', 1) AS INT) - 1 AS page, trim(regexp_extract(content, '<figcaption>(.*?)</figcaption>', 1)) AS caption FROM ({_FIG}))""")
def figure_parse(s, d):
    return figures.parsed(_figure_texts(s, d), "p_partkey").select("p_partkey", F.col("page").cast("bigint").alias("page"), F.get("bbox", F.lit(0)).alias("y0"), "caption", "status")


@query(f"SELECT p_partkey, p_partkey % 10 = 0 AS incomplete FROM ({_FIG})")
def figure_completeness(s, d):
    return _figure_texts(s, d).select("p_partkey", geo.incomplete_figures(F.col("content")).alias("incomplete"))


def _boxes(s, d) -> tuple[DataFrame, DataFrame]:
    p = F.col("p_partkey").cast("bigint")
    even = p % 2 == 0
    x, y = F.when(even, (p * 37) % 800).otherwise(((p - 1) * 37) % 800 + p % 90), F.when(even, (p * 53) % 800).otherwise(((p - 1) * 53) % 800 + p % 70)
    size = F.when(even, 150).otherwise(140)
    rows = table(s, d, "part").select(F.floor(p / 8).cast("bigint").alias("page"), p.alias("box_id"), even.alias("f"), x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))
    return rows.where("f").drop("f"), rows.where("not f").drop("f")


_PAIRS = """boxes AS (SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS page, CAST(p_partkey AS BIGINT) AS box_id, p_partkey % 2 = 0 AS f, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey * 37) % 800 ELSE ((p_partkey - 1) * 37) % 800 + p_partkey % 90 END AS x0,
  CASE WHEN p_partkey % 2 = 0 THEN (p_partkey * 53) % 800 ELSE ((p_partkey - 1) * 53) % 800 + p_partkey % 70 END AS y0, CASE WHEN p_partkey % 2 = 0 THEN 150 ELSE 140 END AS s FROM part),
measured AS (SELECT a.page, a.box_id AS figure_id, b.box_id AS detected_id, greatest(0, least(a.x0 + a.s, b.x0 + b.s) - greatest(a.x0, b.x0)) * greatest(0, least(a.y0 + a.s, b.y0 + b.s) - greatest(a.y0, b.y0)) AS inter,
  a.s * a.s + b.s * b.s AS areas, sqrt(power((2 * a.x0 + a.s - 2 * b.x0 - b.s) / 2.0::DOUBLE, 2) + power((2 * a.y0 + a.s - 2 * b.y0 - b.s) / 2.0::DOUBLE, 2)) AS distance FROM boxes a JOIN boxes b ON a.page = b.page AND a.f AND NOT b.f)"""


@query(f"""WITH {_PAIRS} SELECT page, figure_id, detected_id, CASE WHEN iou > 0.5 THEN 'iou' ELSE 'distance' END AS method, round(CASE WHEN iou > 0.5 THEN iou ELSE distance END, 6) AS score
FROM (SELECT *, inter::DOUBLE / (areas - inter) AS iou FROM measured) WHERE iou > 0.5 OR distance < 200""")
def box_candidates(s, d):
    return figures.candidates(*_boxes(s, d), ["page"])


@query()
def box_matches(s, d):
    return figures.matches(figures.candidates(*_boxes(s, d), ["page"]), ["page"])


# dataset


@query("""SELECT c.md5 AS id, CASE WHEN TRY_CAST(publish_date AS INT) BETWEEN 0 AND 65535 THEN TRY_CAST(publish_date AS INT) END AS publish_year, genre, text FROM documents t JOIN doc_catalog c ON t.md5 = c.md5 WHERE text IS NOT NULL AND text <> ''""")
def structured_dataset(s, d):
    return dataset.rows(table(s, d, "documents"), _cat(s, d))


@query("SELECT md5 FROM documents WHERE md5 IS NULL OR md5 NOT IN (SELECT md5 FROM doc_catalog)")
def dataset_anti(s, d):
    return dataset.unmatched(table(s, d, "documents"), _cat(s, d))


@query("""WITH sized AS (SELECT doc_id, octet_length(encode(text)) AS bytes FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(0 AS BIGINT) AS bucket, CAST(greatest(floor((row_number() OVER w - 1) / 20000), floor((sum(bytes) OVER w - bytes) / 805306368)) AS BIGINT) AS shard
FROM sized WINDOW w AS (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)""")
def shard_plan(s, d):
    rows = table(s, d, "documents").where("text is not null").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    return dataset.shard_plan(rows, "doc_id", "bytes").withColumn("bucket", F.col("bucket").cast("bigint"))


@query("""SELECT event_id, strftime(ts - INTERVAL 9 HOUR, '%Y%m%d') || CASE WHEN hour(ts) < 9 THEN '_1' ELSE '_0' END AS bucket FROM events""")
def halfday_bucket(s, d):
    return table(s, d, "events").select("event_id", files.half_day(F.col("ts")).alias("bucket"))


@query("SELECT md5, ya_public_url AS url FROM doc_catalog WHERE ya_public_url IS NOT NULL")
def encryption_round_trip(s, d):
    """Links decrypted again after encryption; the ciphertext itself differs each time."""
    key = F.lit("0123456789abcdef")
    rows = _cat(s, d).where("ya_public_url is not null")
    return rows.select("md5", files.decrypt(files.encrypt(F.col("ya_public_url"), key), key).alias("url"))


@query("SELECT md5(text) AS content_md5, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_hashes(s, d):
    return table(s, d, "documents").where("text is not null").groupBy(F.md5("text").alias("content_md5")).agg(F.count("*").alias("n"))


@query()
def zip_round_trip(s, d):
    """Texts packed into one-member archives and read again, with the error of those that can't be."""
    rows = table(s, d, "doc_chunks").where("content is not null").select("chunk_id", files.zipped(F.col("chunk_id").cast("string"), F.col("content")).alias("z"), "content")
    out = rows.select("chunk_id", "content", files.unzipped(F.col("z")).alias("u"))
    return out.select("chunk_id", (F.col("u.text") == F.col("content")).alias("same"), "u.error")
