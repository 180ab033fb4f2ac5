"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, htmlextract, jaccard, langid, licenses, media, mixing, sharding, toxicity, urlfilter
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(f: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: f(*[table(spark, sf_dir, n) for n in names])


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": _over(mixing.op1, "documents"),
        "op2_media": _over(media.op2, "documents"),
        "op3_decontamination": _over(decontam.op3, "documents", "benchmark"),
        "op4_url_filters": _over(urlfilter.op4, "pages"),
        "op5_toxicity": _over(toxicity.op5, "documents", "labels"),
        "op6_licenses": _over(licenses.op6, "documents"),
        "op7_language": _over(langid.op7, "documents"),
        "op8_html": _over(htmlextract.op8, "pages"),
        "op9_jaccard": _over(jaccard.op9, "documents"),
        "op10_sharding": _over(sharding.op10, "documents"),
    }


#: The n-gram join by its definition: all pairs that share a shingle, and everything that links reach.
_JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i : array_to_string(w[i:i + 3], ' ')) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), r AS (
  SELECT doc_id AS id, doc_id AS comp FROM documents UNION SELECT l.y, r.comp FROM r JOIN l ON l.x = r.id
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.comp) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.id = d.doc_id GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """Of these operators only the n-gram join has a result that SQL can say and reach; the others are held to brute force in tests/llm."""
    return {"op9_jaccard": _JACCARD}
