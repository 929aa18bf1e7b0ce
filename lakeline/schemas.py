"""Declared schemas; nothing the engine writes or reads from landing folders is inferred."""

from pyspark.sql import types as T


FINDING = "struct<category: string, description_en: string, is_actual_finding: boolean, pest_type: string, enforcement: string, resolved: boolean>"
FLAGS = ("has_pest", "has_indskaerpelse", "has_paabud", "has_forbud", "has_boede", "has_gebyr", "has_politianmeldelse", "has_autorisation_frataget")

_DDL = {
    "PAGES": "url string, html string",
    "SNAPSHOTS": "snap_id long, source string, kind string, fetched_at double, url string, path string, sha256 string, bytes long, changed boolean",
    "ITEMS": "seq long, pipeline string, key string, status string, sha256 string, path string, attempts long, error string, meta string, updated_at double, loaded_at double",
    "ITEM_EVENTS": "seq long, pipeline string, key string, kind string, status string, sha256 string, path string, error string, meta string, bump boolean, updated_at double",
    "RUNS": "run_id long, pipeline string, started_at double, finished_at double, ok boolean, note string",
    "EXTRACT": "report_id string, navnelbnr string, doc_type string, n_pages long, n_chars long, control_points array<string>, sections map<string,string>, " + ", ".join(f"{f} boolean" for f in FLAGS) + ", text string, error string",
    "FINDINGS": f"report_id string, navnelbnr string, severity string, overall_llm string, summary_en string, n_findings long, n_actual_findings long, actual_pest boolean, max_enforcement string, findings array<{FINDING}>",
    "TRANSLATIONS": "report_id string, navnelbnr string, text_en string",
    "MEMO": "k string, da string, en string, hits long, created_at double",
    "PAGE_LINES": "report_id string, page int, idx int, page_width double, page_height double, text string, x0 double, y0 double, x1 double, y1 double, size double, color int, bold boolean, baseline double",
    "TEMPLATE_SPECS": "variant string, width int, height int, built_at double, boxes array<struct<bbox: array<int>, da: string, en: string, conf: double, fill: array<int>, color: array<int>, bold: boolean, avail_x1: int, font_px: double, baseline_px: double>>",
    "ARTICLES": "id string, source string, entry_id string, title string, summary string, link string, published string, fetched_at double",
    "FEED_ENTRIES": "source string, entry_id string, title string, summary string, link string, published string, updated string, fetched_at double, seq long",
    "FEED_STATE": "source string, etag string, modified string",
    "POLL_LOG": "ran_at double, source string, entries long, new long, error string",
    "STATUS_HISTORY": "t double, reports_done long, pdf_bytes long, extracted long, analyzed long, overlay_done long",
    "CONTROL": "paused boolean, harvest_rate double, analyze_concurrency int, overlay_concurrency int",
}


def __getattr__(name: str) -> T.StructType:
    """PAGES, ITEMS, ...: made when asked for, since parsing them needs a session."""
    if name in _DDL:
        return T.StructType.fromDDL(_DDL[name])
    raise AttributeError(name)
