"""Schemas of the tables. Ordinals are columns: rows have no order of their own."""

from __future__ import annotations

WORD = "struct<text:string,bbox:array<double>,confidence:double>"
LINE = f"struct<text:string,normalized:string,confidence:double,bbox:array<double>,words:array<{WORD}>>"
PAGE_KEY = ["issue_id", "page_number"]
SIDES = ["x0", "y0", "x1", "y1"]
_BOX = "x0 double, y0 double, x1 double, y1 double"

OCR_LINES = f"issue_id string, page_number int, line_no int, text string, confidence double, {_BOX}, words array<{WORD}>"
EMBEDDED_LINES = f"issue_id string, page_number int, line_no int, text string, confidence double, {_BOX}"
MERGED_LINES = f"issue_id string, page_number int, line_no int, text string, confidence double, {_BOX}, words array<{WORD}>, source string"
LAYOUT_BOXES = f"issue_id string, page_number int, box_no int, label string, position int, confidence double, {_BOX}, polygon array<array<double>>"
PAGE_SIZES = "issue_id string, page_number int, width int, height int, embedded_text string"
PDF_PAGES = f"issue_id string, page_number int, pt_width double, pt_height double, text string, image string, lines array<struct<text:string,{','.join(f'{s}:double' for s in SIDES)}>>"
ISSUE_INDEX = (
    "issue_id string, newspaper string, newspaper_source string, date string, source_pdf string, page_count long, block_count long, article_count long,"
    " processed_at string, output_dir string, city string, province string, country string, place_source string, masthead string,"
    " year string, month string, day string, day_of_week string, date_precision string"
)
ARTICLES = (
    "issue_id string, page_number int, article_seq int, article_id string, title string, block_ids array<string>, reading_order_start int, reading_order_end int,"
    " label_counts map<string,int>, text_normalized string, word_count int, continued_on_page int, continued_from_page int, bbox array<double>,"
    " continues_in_article_id string, continues_from_article_id string"
)
FLAT_BLOCKS = (
    "block_id string, issue_id string, newspaper string, issue_date string, page_number int, label string, reading_order int, bbox array<double>, layout_confidence double,"
    " ocr_confidence double, source string, article_id string, article_title string, text_original string, text_normalized string"
)
CORRECTIONS = "issue_id string, article_id string, corrected_text string, model string, corrected_at string"

_WORD_JSON = "struct<text:string,bbox:array<double>,confidence:double>"
LAYOUT_JSON = (
    f"ocr struct<text_lines:array<struct<text:string,confidence:double,bbox:array<double>,words:array<{_WORD_JSON}>>>>,"
    " layout struct<bboxes:array<struct<label:string,position:int,confidence:double,bbox:array<double>,polygon:array<array<double>>>>>"
)
