"""Plug-ins for what needs a native library or a model: PDF pages, layout, recognition, correction.

Each runs inside mapInPandas, so a library or model is loaded once per Python
worker, and none is imported unless its provider is used.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from pressline.sources import schemas as S


class PageParser(Protocol):
    """S2-S5, K1. One PDF to rows of schemas.PDF_PAGES: size, text, lines and the path of the page image."""

    def __call__(self, issue_id: str, content: bytes) -> list[dict[str, Any]]: ...


class ImageModel(Protocol):
    """S8, S9. A page image to the text_lines or bboxes part of schemas.LAYOUT_JSON."""

    def __call__(self, image: str) -> list[dict[str, Any]]: ...


class Corrector(Protocol):
    """X32. (text, secondary reading) to the model's raw answer."""

    def __call__(self, text: str, secondary: str) -> str: ...


def parse_pdfs(pdfs: DataFrame, make_parser: Callable[[], PageParser]) -> DataFrame:
    """S2-S5. One parse for each PDF; all that is needed of a page comes from it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = make_parser()
        for batch in batches:
            for issue_id, content in zip(batch["issue_id"], batch["content"], strict=True):
                yield pd.DataFrame(parse(issue_id, content), columns=["issue_id", "page_number", "pt_width", "pt_height", "text", "image", "lines"])

    return pdfs.select("issue_id", "content").mapInPandas(run, S.PDF_PAGES)


def detect(pages: DataFrame, make_ocr: Callable[[], ImageModel], make_layout: Callable[[], ImageModel]) -> DataFrame:
    """S8-S10. Rows as read_layouts gives them, from page images."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ocr, layout = make_ocr(), make_layout()
        for batch in batches:
            out = batch[["issue_id", "page_number"]].copy()
            out["ocr"] = [{"text_lines": ocr(image)} for image in batch["image"]]
            out["layout"] = [{"bboxes": layout(image)} for image in batch["image"]]
            yield out

    return pages.select("issue_id", "page_number", "image").mapInPandas(run, f"issue_id string, page_number int, {S.LAYOUT_JSON}")


def _rows(found: Any, fields: dict[str, Callable[[Any], Any]]) -> list[dict[str, Any]]:
    """Objects or dicts as dicts of plain values; a field that is missing or None is given to its reader as None."""
    read = lambda x, name: x.get(name) if isinstance(x, dict) else getattr(x, name, None)
    return [{name: reader(read(x, name)) for name, reader in fields.items()} for x in found or []]


def _number(v: Any) -> float:
    return float(v or 0)


def _numbers(v: Any) -> list[float]:
    return [float(x) for x in (v if v is not None else (0, 0, 0, 0))]


# The fields of a recognised line, its words, and a layout box.
_WORD_FIELDS: dict[str, Callable[[Any], Any]] = {"text": lambda v: v or "", "bbox": _numbers, "confidence": lambda v: round(_number(v), 4)}
_LINE_FIELDS: dict[str, Callable[[Any], Any]] = {"text": lambda v: v or "", "confidence": _number, "bbox": _numbers, "words": lambda v: _rows(v, _WORD_FIELDS)}
_BOX_FIELDS: dict[str, Callable[[Any], Any]] = {"label": lambda v: v or "Text", "position": lambda v: int(v or 0), "confidence": _number, "bbox": _numbers, "polygon": lambda v: [_numbers(p) for p in (v if v is not None else [])]}


def recognition(predict: Callable[[list[Any]], list[Any]], load: Callable[[str], Any]) -> ImageModel:
    """S9, S10. A text recognition model as a plug-in. predict takes images and gives one result each with
    `text_lines`; load opens the path of a page image."""
    return lambda image: _rows(getattr(predict([load(image)])[0], "text_lines", None), _LINE_FIELDS)


def layout(predict: Callable[[list[Any]], list[Any]], load: Callable[[str], Any]) -> ImageModel:
    """S8, S10. A layout model as a plug-in, as recognition(); its results have `bboxes`."""
    return lambda image: _rows(getattr(predict([load(image)])[0], "bboxes", None), _BOX_FIELDS)


def fitz_parser(image_folder: str | None = None, dpi: int = 300) -> PageParser:
    """A parser on PyMuPDF, where it is installed; page images go to image_folder, a shared path."""
    import fitz

    def parse(issue_id: str, content: bytes) -> list[dict[str, Any]]:
        rows = []
        with fitz.open(stream=content, filetype="pdf") as doc:
            for i, page in enumerate(doc):
                image = None
                if image_folder:
                    image = f"{image_folder}/{issue_id}/pages/page_{i + 1:03d}/page.png"
                    os.makedirs(os.path.dirname(image), exist_ok=True)
                    page.get_pixmap(dpi=dpi).save(image)
                lines = [{"text": "".join(s["text"] for s in ln["spans"]), **dict(zip(S.SIDES, ln["bbox"], strict=True))} for b in page.get_text("dict")["blocks"] for ln in b.get("lines", [])]
                rows.append({"issue_id": issue_id, "page_number": i + 1, "pt_width": page.rect.width, "pt_height": page.rect.height, "text": page.get_text("text"), "image": image, "lines": lines})
        return rows

    return parse
