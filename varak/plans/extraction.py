"""Queries of extraction, layout and reconciliation beside those of ``reference``, and views that hold every pattern.

The views put the patterns that the tables lack (images, tables of contents, old exports, rescued types) into whole
tables, by the same SQL text in Spark and in the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from varak import rules
from varak.functions import geo, meta
from varak.functions import text as T
from varak.operators import assemble, catalog, figures, prompts, reconcile, triage
from varak.plans.reference import _LIMITED, _NONDOC, _NORMAL, _PDF, _PLAN, _SKIP, _TARGET, ORACLE, QUERIES, _cat, _ranges, _skip, _totals, query
from varak.sources import files
from varak.sources.tables import table

__all__ = ["ORACLE", "QUERIES"]

_MARKED = """concat(CASE WHEN doc_id % 7 = 0 THEN concat('xml version=''1.0'' encoding=''utf-8''?', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 5 = 1 THEN concat('- item', chr(10), 'hy-', chr(10), 'phen ', chr(10)) ELSE '' END, text,
  CASE WHEN doc_id % 3 = 0 THEN concat(chr(10), '____________________ ![a](b.png) <img alt="" src="c.png">') ELSE '' END,
  CASE WHEN doc_id % 6 = 3 THEN concat(chr(10), '<table class="toc"><tr></tr></table>') ELSE '' END,
  CASE WHEN doc_id % 4 = 2 THEN concat(chr(10), '![](x.png) a', chr(92), '_b', chr(92), '<c ', chr(92), chr(92), ' dN=`q</a>`{=html}') ELSE '' END)"""


@query(f"SELECT doc_id, {_NORMAL} AS text FROM (SELECT doc_id, {_MARKED} AS content FROM documents WHERE text IS NOT NULL)")
def texts_cleaned(s, d):
    """The clean-up of texts that hold each of its patterns."""
    rows = table(s, d, "documents").where("text is not null").select("doc_id", F.expr(_MARKED.replace("''1.0''", "\\'1.0\\'").replace("''utf-8''", "\\'utf-8\\'")).alias("content"))
    return rows.select("doc_id", T.normalize(F.col("content")).alias("text"))


_PATHS = """SELECT md5, concat(CASE WHEN length(file_path) % 2 = 0 THEN 'disk:' ELSE '' END, file_path, CASE length(file_path) % 4 WHEN 0 THEN '.eaf' WHEN 1 THEN '.musx' WHEN 2 THEN '.pdf' ELSE '.txt' END) AS path,
  CASE length(file_path) % 3 WHEN 0 THEN 'application/octet-stream' WHEN 1 THEN 'text/html' ELSE mime_type END AS mime_type FROM {} WHERE file_path IS NOT NULL"""


@query(f"""SELECT md5, regexp_replace(path, '^disk:', '') AS path, coalesce(mime_type IN {_NONDOC}, false) OR ends_with(path, '.eaf') OR ends_with(path, '.musx') AS nontextual,
  coalesce(mime_type IN {_NONDOC}, false) AND NOT (mime_type = 'application/octet-stream' AND ends_with(path, '.pdf') OR mime_type = 'text/html' AND ends_with(path, '.txt')) AS skip,
  CASE WHEN mime_type = 'application/octet-stream' AND ends_with(path, '.pdf') THEN 'application/pdf' WHEN mime_type = 'text/html' AND ends_with(path, '.txt') THEN 'text/plain' ELSE mime_type END AS mime_type FROM ({_PATHS.format('listing')})""")
def types_rescued(s, d):
    rows = s.sql(_PATHS.format("{listing}"), listing=table(s, d, "listing"))
    by_type = catalog.skip_by_type(F.col("mime_type"), F.col("path"))
    return rows.select("md5", F.regexp_replace("path", "^disk:", "").alias("path"), catalog.nontextual(F.col("mime_type"), F.col("path")).alias("nontextual"), by_type["skip"].alias("skip"), by_type["mime_type"].alias("mime_type"))


@query(f"""SELECT md5, CASE WHEN is_full IS NOT TRUE THEN 'not full' WHEN sharing_restricted THEN 'sharing restricted' WHEN coalesce(isbn, '') <> '' THEN NULL WHEN ends_with(path, '.pdf') THEN 'legal doc' END AS reason
FROM (SELECT *, concat('/corpus/архив/закон/', md5, CASE WHEN page_count % 2 = 0 THEN '.pdf' ELSE '.txt' END) AS path FROM doc_catalog) WHERE lib IS NULL AND language IN {_TARGET} AND content_url IS NOT NULL""")
def legal_documents(s, d):
    path = F.concat(F.lit("/corpus/архив/закон/"), "md5", F.when(F.col("page_count") % 2 == 0, ".pdf").otherwise(".txt"))
    return catalog.library_candidates(_cat(s, d).withColumn("ya_path", path)).select("md5", "reason")


@query("SELECT md5 FROM doc_catalog WHERE sharing_restricted AND page_count % 2 = 1 AND ya_public_url IS NOT NULL")
def links_left_plain(s, d):
    """Restricted records whose links are still plain after those with an even number of pages were encrypted."""
    link = F.when(F.col("page_count") % 2 == 0, F.concat(F.lit("enc:"), "ya_public_url")).otherwise(F.when(F.col("page_count") % 2 == 1, F.col("ya_public_url")))
    return catalog.unencrypted(_cat(s, d).withColumns({"ya_public_url": link, "document_url": F.lit(None).cast("string")})).select("md5")


@query("SELECT md5, CASE WHEN page_count % 2 = 0 THEN 'id, size' ELSE 'id' END AS keys FROM doc_catalog WHERE page_count IS NOT NULL")
def supplied_keys(s, d):
    """Keys that are left of supplied metadata with all those that are dropped."""
    dropped = "".join(f', "{k}": "x"' for k in rules.DROPPED_KEYS)
    raw = F.concat(F.lit('{"id": "'), "md5", F.lit('"' + dropped), F.when(F.col("page_count") % 2 == 0, ', "size": "1"').otherwise(""), F.lit("}"))
    kept = meta.without_dropped_keys(raw)
    return _cat(s, d).where("page_count is not null").select("md5", F.array_join(F.array_sort(F.json_object_keys(kept)), ", ").alias("keys"))


# listing and catalogue


@query("""WITH up AS (SELECT md5, max(upstream_meta_url) AS url FROM doc_catalog WHERE upstream_meta_url IS NOT NULL GROUP BY md5)
SELECT l.md5, l.file_path, up.url AS upstream_meta_url FROM (SELECT md5, file_path FROM listing WHERE entry_type = 'file') l LEFT JOIN up ON l.md5 = up.md5""")
def listing_upstream(s, d):
    upstream = _cat(s, d).where("upstream_meta_url is not null").select("md5", F.col("upstream_meta_url").alias("url"))
    return reconcile.with_upstream(table(s, d, "listing").where("entry_type = 'file'").select("md5", "file_path"), upstream)


@query("""WITH second AS (SELECT md5, min(file_path) AS path FROM listing WHERE md5 IS NOT NULL AND file_path IS NOT NULL GROUP BY md5)
SELECT coalesce(n.md5, o.md5) AS md5, coalesce(n.path, o.ya_path) AS path FROM doc_catalog o FULL JOIN second n ON o.md5 = n.md5""")
def corpora_merged(s, d):
    second = table(s, d, "listing").where("md5 is not null and file_path is not null").groupBy("md5").agg(F.min("file_path").alias("path"))
    return reconcile.merged(_cat(s, d).select("md5", F.col("ya_path").alias("path")), second)


@query(f"""WITH {_PLAN}, {_LIMITED.replace('named AS', 'named AS', 1)},
stored AS (SELECT md5, 'old/' || mime_type AS destination, 0 AS rank FROM doc_catalog WHERE page_count % 9 = 0 AND mime_type IS NOT NULL UNION ALL SELECT DISTINCT md5, 'void', 0.5 FROM matches)
SELECT md5, arg_max(destination, rank) AS destination FROM (SELECT md5, destination, 9 AS rank FROM plan UNION ALL SELECT * FROM stored) GROUP BY md5""")
def wiping_plan_stored(s, d):
    """The plan over a stored one, with incomplete files that are also there in full."""
    c = _cat(s, d)
    stored = c.where("page_count % 9 = 0 and mime_type is not null").select("md5", F.concat(F.lit("old/"), "mime_type").alias("destination"))
    return reconcile.wiping_plan(c, stored, reconcile.limited_matches(table(s, d, "listing")))


@query("SELECT md5, language, row_number() OVER (PARTITION BY language ORDER BY coalesce(ya_public_url, ''), md5) AS place FROM doc_catalog WHERE language IS NOT NULL")
def display_order(s, d):
    rows = _cat(s, d).where("language is not null").select("md5", "language", "ya_public_url")
    return reconcile.display_order(rows, "language", "ya_public_url").select("md5", "language", F.col("place").cast("bigint").alias("place"))


@query(f"SELECT md5 FROM doc_catalog WHERE mime_type IN {_PDF} UNION SELECT md5 FROM {_SKIP} UNION SELECT md5 FROM documents WHERE md5 IS NOT NULL")
def hashes_united(s, d):
    skip, texts = _skip(s, d), table(s, d, "documents").where("md5 is not null").select("md5")
    return _cat(s, d).where(F.col("mime_type").isin(*rules.PDF_TYPES)).select("md5").union(skip).union(texts).distinct()


@query("SELECT md5, NOT contains(file_path, '/limited/') AS is_full, contains(file_path, '/scan/') AS restricted FROM listing WHERE file_path IS NOT NULL")
def completeness_marks(s, d):
    path = F.col("file_path")
    return table(s, d, "listing").where("file_path is not null").select("md5", catalog.full(path).alias("is_full"), catalog.restricted(path).alias("restricted"))


@query(" , ".join([f"SELECT (SELECT count(*) FROM ({ORACLE['nonpdf_work_queue']})) AS nonpdf", *[f"(SELECT count(*) FROM ({ORACLE[q]})) AS {k}" for k, q in (("pdf", "pdf_work_queue"), ("meta", "meta_work_queue"), ("upload", "upload_queue"), ("layout", "layout_queue"))]]))
def queue_sizes(s, d):
    return catalog.queue_sizes(_cat(s, d), _skip(s, d))


@query("SELECT obj_key, regexp_extract(obj_key, '([^/]+)$', 1) AS name FROM (SELECT DISTINCT 'content/' || md5 || '.zip' AS obj_key FROM doc_catalog) WHERE obj_key[9:40] NOT IN (SELECT md5 FROM listing WHERE md5 IS NOT NULL)")
def objects_to_fetch(s, d):
    keys = _cat(s, d).select(F.concat(F.lit("content/"), "md5", F.lit(".zip")).alias("obj_key"))
    return files.to_fetch(keys, table(s, d, "listing").where("md5 is not null").select(F.concat(F.lit("/tmp/"), "md5", F.lit(".zip")).alias("path")))


@query("SELECT regexp_replace(obj_key, '\\.zip$', '') AS md5, obj_key AS url FROM (SELECT md5 || '.zip' AS obj_key FROM doc_catalog)")
def upstream_objects(s, d):
    return files.upstream_keys(_cat(s, d).select(F.concat("md5", F.lit(".zip")).alias("obj_key")).withColumn("url", F.col("obj_key")))


# requests and their outcome


@query("SELECT doc_id, md5(left(text, 30000)) AS slice_md5, least(length(text), 30000) AS n FROM documents WHERE text IS NOT NULL")
def metadata_slices(s, d):
    part = catalog.meta_slice(F.col("text"))
    return table(s, d, "documents").where("text is not null").select("doc_id", F.md5(part).alias("slice_md5"), F.length(part).cast("bigint").alias("n"))


@query("SELECT md5, unnest(range(least(page_count, 30))) AS page FROM doc_catalog WHERE page_count > 0")
def layout_pages(s, d):
    return catalog.layout_pages(_totals(s, d)).select("md5", F.col("page").cast("bigint").alias("page"))


_ATTEMPTS = """SELECT chunk_id, md5, CASE chunk_id % 8 WHEN 1 THEN 'server' WHEN 2 THEN 'client' WHEN 3 THEN 'client' WHEN 4 THEN 'client' WHEN 5 THEN 'validation' WHEN 6 THEN 'parse' WHEN 7 THEN 'no_box' END AS error,
  CASE WHEN chunk_id % 8 IN (2, 3) THEN 429 WHEN chunk_id % 8 = 4 THEN 400 END AS code, CASE WHEN chunk_id % 8 = 2 THEN 'GenerateContentInputTokensPerModelPerMinute-x' ELSE 'PerDay' END AS message,
  CASE chunk_id % 5 WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS size FROM {}"""
_TRIAGED = """triaged AS (SELECT chunk_id, md5, CASE WHEN error IS NULL THEN 'ok' WHEN error IN ('parse', 'no_box') THEN 'repairable' WHEN error = 'server' OR spent OR size > 1 THEN 'retry' ELSE 'unprocessable' END AS status, spent AS key_expired,
  CASE WHEN error IS NULL OR error IN ('parse', 'no_box', 'server') OR spent THEN size WHEN size > 3 THEN 3 WHEN size > 2 THEN 2 WHEN size > 1 THEN 1 END AS size FROM (SELECT *, coalesce(error = 'client' AND code = 429 AND NOT contains(message, 'PerModelPerMinute'), false) AS spent FROM (""" + _ATTEMPTS.format("doc_chunks") + ")))"


def _attempts(s, d):
    return triage.triaged(s.sql(_ATTEMPTS.format("{chunks}"), chunks=table(s, d, "doc_chunks")))


@query(f"WITH {_TRIAGED} SELECT chunk_id, status, key_expired, size FROM triaged")
def extraction_triage(s, d):
    return _attempts(s, d).select("chunk_id", "status", "key_expired", "size")


@query(f"""WITH {_TRIAGED}, sizes AS (SELECT md5, min(size) AS size FROM triaged WHERE status = 'retry' GROUP BY md5),
pages AS (SELECT d.md5, s.size, unnest(range(page_count)) AS page FROM doc_catalog d JOIN sizes s ON d.md5 = s.md5 WHERE page_count > 0),
free AS (SELECT * FROM pages p WHERE NOT EXISTS (SELECT 1 FROM doc_chunks r WHERE r.md5 = p.md5 AND p.page BETWEEN r.start_page AND r.end_page)),
islands AS (SELECT *, page - row_number() OVER (PARTITION BY md5 ORDER BY page) AS island FROM free),
placed AS (SELECT *, floor((row_number() OVER (PARTITION BY md5, island ORDER BY page) - 1) / size) AS part FROM islands)
SELECT md5, min(page) AS start_page, max(page) AS end_page FROM placed GROUP BY md5, island, part""")
def chunks_replanned(s, d):
    """What is not covered yet of the records with attempts to repeat, in chunks of the size that is next."""
    plan = assemble.gaps(_ranges(s, d), triage.again(_attempts(s, d), _totals(s, d)))
    return plan.select("md5", F.col("start_page").cast("bigint").alias("start_page"), F.col("end_page").cast("bigint").alias("end_page"))


@query("SELECT md5, arg_max(length(content), chunk_id) AS tokens FROM doc_chunks WHERE content IS NOT NULL GROUP BY md5")
def token_usage(s, d):
    return triage.usage(table(s, d, "doc_chunks").select("md5", "chunk_id", F.length("content").cast("bigint").alias("tokens")), "md5", "chunk_id", "tokens")


@query("""SELECT chunk_id, part_no, text FROM (SELECT chunk_id, unnest([1, 2, 3, 4, 5, 6]) AS part_no, unnest([
  concat('Read pages ', start_page, ' to ', end_page, '. Headings so far: ## ', start_page), concat('Pages count from ', start_page, '.'), concat('Footnotes begin at ', end_page + 1, '.'),
  CASE WHEN start_page = 0 THEN 'The first page may hold a title.' ELSE concat('No title stands here. Headings so far: ## ', start_page) END, 'An example.', 'Give the text as JSON.']) AS text
FROM doc_chunks WHERE start_page IS NOT NULL AND end_page IS NOT NULL)""")
def prompt_parts(s, d):
    rows = table(s, d, "doc_chunks").where("start_page is not null and end_page is not null").select(F.col("chunk_id").alias("md5"), "start_page", "end_page", (F.col("end_page") + 1).alias("next_footnote"), F.concat(F.lit("## "), F.col("start_page").cast("string")).alias("hierarchy"))
    return prompts.parts(rows, F.array(F.lit("An example."))).select(F.col("md5").alias("chunk_id"), "part_no", "text")


@query("SELECT row_number() OVER (ORDER BY 'ex' || n_nationkey || '-0.md') AS example_no, 'ex' || n_nationkey || '-1.jpeg' AS image, 'ex' || n_nationkey || '-0.md' AS text FROM nation WHERE n_nationkey % 4 <> 0")
def example_pairs(s, d):
    """Pairs of the example files of each nation, some of which have no image."""
    k = F.col("n_nationkey")
    names = F.array(F.concat(F.lit("ex"), k.cast("string"), F.lit("-0.md")), F.when(k % 4 != 0, F.concat(F.lit("ex"), k.cast("string"), F.lit("-1.jpeg"))))
    pairs = prompts.example_pairs(table(s, d, "nation").select(F.explode(names).alias("name")).where("name is not null"))
    return pairs.select(F.col("example_no").cast("bigint").alias("example_no"), "image", "text")


# figures and layouts: every part is a page of 1000 by 2000 pixels with one figure, two of three with a detected box

_PAGE_SQL = """pages AS (SELECT CAST(p_partkey AS BIGINT) AS id, p_name, p_partkey % 300 AS y, p_partkey % 200 AS x, p_partkey % 3 <> 0 AS seen, p_partkey % 2 = 0 AS captioned, p_partkey % 90 AS dx, p_partkey % 700 AS dy FROM part),
html AS (SELECT *, concat('<figure data-bbox="[', y, ', ', x, ', ', y + 100, ', ', x + 150, ']" data-page="1">', CASE WHEN captioned THEN concat('<figcaption>', p_name, '</figcaption>') ELSE '' END, '</figure>') AS html FROM pages),
measured AS (SELECT *, greatest(0, 150 - dx) * greatest(0, 200 - dy) AS inter, sqrt(dx * dx + dy * dy) AS distance FROM html),
matched AS (SELECT *, seen AND (inter::DOUBLE / (60000 - inter) > 0.5 OR distance < 300) AS met FROM measured)"""


def _figures(s, d):
    k = F.col("p_partkey")
    at = lambda x: x.cast("string")
    box = F.concat(F.lit('<figure data-bbox="['), at(k % 300), F.lit(", "), at(k % 200), F.lit(", "), at(k % 300 + 100), F.lit(", "), at(k % 200 + 150), F.lit(']" data-page="1">'))
    text = F.concat(F.lit("before "), box, F.when(k % 2 == 0, F.concat(F.lit("<figcaption>"), "p_name", F.lit("</figcaption>"))).otherwise(""), F.lit("</figure> after"))
    texts = table(s, d, "part").select(k.cast("bigint").alias("id"), text.alias("content"))
    found = figures.parsed(texts, "id").where("status = 'ok'").withColumn("px", geo.to_pixels(F.col("bbox"), F.lit(1000), F.lit(2000)))
    own = found.select("id", "page", F.col("figure_no").alias("box_id"), *[F.col("px")[n].alias(c) for n, c in enumerate(("x0", "y0", "x1", "y1"))], "html", "caption")
    p = table(s, d, "part").where("p_partkey % 3 <> 0")
    x0, y0 = k % 200 + k % 90, (k % 300) * 2 + k % 700
    boxes = p.select(k.cast("bigint").alias("id"), F.lit(0).alias("page"), F.lit(7).alias("box_id"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), (x0 + 150).cast("double").alias("x1"), (y0 + 200).cast("double").alias("y1"))
    return texts, own, boxes


@query(f"""WITH {_PAGE_SQL} SELECT id, concat('before ', CASE WHEN met THEN concat('<figure style="text-align: center; margin: 1em 0;"><img alt="" src="https://img/', id, '-0-0.png" style="max-width: 800px; width: 50%; height: auto;">',
  CASE WHEN captioned THEN concat('<figcaption>', p_name, '</figcaption>') ELSE '' END, '</figure>', chr(10)) ELSE '' END, ' after') AS content FROM matched""")
def figures_replaced(s, d):
    """Figures matched to detected boxes, replaced by their clips; unmatched ones are taken out."""
    texts, own, boxes = _figures(s, d)
    keys = ["id", "page"]
    pairs = figures.matches(figures.candidates(own, boxes, keys, 1000, 2000), keys)
    clips = figures.clip_order(boxes.join(pairs.select(*keys, F.col("detected_id").alias("box_id"), "figure_id"), [*keys, "box_id"]), keys)
    url = F.concat(F.lit("https://img/"), F.concat_ws("-", F.col("id").cast("string"), F.col("page").cast("string"), F.col("clip_no").cast("string")), F.lit(".png"))
    done = figures.replacements(own.withColumnRenamed("box_id", "figure_id"), clips.withColumn("url", url), keys)
    return figures.replaced(texts, done, "id")


@query(f"WITH {_PAGE_SQL} SELECT id, x::DOUBLE AS x0, (2 * y)::DOUBLE AS y0, (x + 150)::DOUBLE AS x1, (2 * y + 200)::DOUBLE AS y1 FROM pages")
def figure_pixels(s, d):
    return _figures(s, d)[1].select("id", "x0", "y0", "x1", "y1")


@query("SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS md5, CAST(p_partkey % 8 % 3 AS INT) AS page, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS html FROM part GROUP BY 1, 2")
def figures_by_page(s, d):
    k = F.col("p_partkey")
    rows = table(s, d, "part").select(F.floor(k / 8).cast("bigint").alias("md5"), (k % 8 % 3).cast("int").alias("page"), k.alias("figure_no"), k.cast("string").alias("html"), F.lit(None).cast("array<double>").alias("bbox"), F.lit(None).cast("string").alias("caption"))
    return figures.by_page(rows).select("md5", "page", F.size("figures").cast("bigint").alias("n"), F.array_join("figures.html", ",").alias("html"))


@query("SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS page, CAST(p_partkey AS BIGINT) AS box_id, row_number() OVER (PARTITION BY floor(p_partkey / 8) ORDER BY p_partkey * 37 % 5, p_partkey * 53 % 7, p_partkey) - 1 AS clip_no FROM part")
def clips_in_order(s, d):
    k = F.col("p_partkey").cast("bigint")
    rows = table(s, d, "part").select(F.floor(k / 8).cast("bigint").alias("page"), k.alias("box_id"), (k * 37 % 5).alias("x0"), (k * 53 % 7).alias("y0"))
    return figures.clip_order(rows, ["page"]).select("page", "box_id", F.col("clip_no").cast("bigint").alias("clip_no"))


def _detected(s, d):
    k = F.col("p_partkey").cast("bigint")
    kind = F.element_at(F.array(*map(F.lit, ("Picture", "Text", "Table"))), (k % 3 + 1).cast("int"))
    at = [(k * m % 500 + add).cast("double").alias(c) for c, m, add in (("x0", 37, 0), ("y0", 53, 0), ("x1", 37, 120), ("y1", 53, 90))]
    return table(s, d, "part").select(F.floor(k / 8).cast("bigint").alias("page"), k.alias("box_id"), kind.alias("class"), (k % 997 / 997).alias("conf"), F.lit(1000).alias("w"), F.lit(1400).alias("h"), *at)


@query("SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS page, CAST(p_partkey AS BIGINT) AS box_id, CAST(round((p_partkey % 997)::DOUBLE / 997, 2) AS VARCHAR) AS conf FROM part WHERE p_partkey % 3 = 0")
def detections_named(s, d):
    return figures.detections(_detected(s, d)).select("page", "box_id", "conf")


@query("""SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS page, CAST(p_partkey AS BIGINT) AS box_id, CASE p_partkey % 3 WHEN 0 THEN 'picture' WHEN 1 THEN 'text' ELSE 'table' END AS class,
  round((p_partkey * 37 % 500) * 595.0::DOUBLE / 1000, 6) AS x0, round((p_partkey * 53 % 500 + 90) * 842.0::DOUBLE / 1400, 6) AS y1 FROM part""")
def layouts_rescaled(s, d):
    """Layout records of each page, and their boxes in the space of a page of 595 by 842 points."""
    records = figures.layout_records(_detected(s, d), ["page"])
    return figures.rescaled(records, ["page"], F.lit(595.0), F.lit(842.0)).select("page", "box_id", "class", F.round("x0", 6).alias("x0"), F.round("y1", 6).alias("y1"))
