"""Query op5: ``pages`` written as WARC archives and read back."""

from __future__ import annotations

from .common import table
from .registry import register
from .warc_shards import archive_folder, read_archives, write_archives

ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS n, sha256(t) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h
"""


@register("op5_warc_shards", ORACLE)
def op5_warc_shards(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = archive_folder(spark)
    write_archives(pages, folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
