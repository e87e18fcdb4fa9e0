"""Interfaces to the outside: fetching, recognition, judgement. Implementations are injected."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from foliant.session import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fetch = Callable[[str], bytes]
Recognise = Callable[[bytes, str], tuple[str, float]]


def fetch_documents(refs: DataFrame, fetch: Fetch, attempts: int = 3, pause: float = 1.5, partitions: int | None = None) -> DataFrame:
    """(url, content, error, attempts) of every row with a ``url``; failures are rows, never exceptions.

    Rows of a host share a partition, and one task waits ``pause`` seconds between its requests to
    the host, so the rate holds however many executors there are. A host with most of the rows is
    as slow as its own limit.
    """
    ship(refs.sparkSession)
    host = F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]+)", 1))
    spread = refs.select("url", host.alias("host"))
    spread = spread.repartition(partitions, "host") if partitions else spread.repartition("host")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: dict[str, float] = {}
        for b in batches:
            rows = []
            for url, h in zip(b["url"], b["host"]):
                content, error, n = None, None, 0
                for n in range(1, attempts + 1):
                    time.sleep(max(0.0, ready.get(h, 0.0) - time.monotonic()))
                    ready[h] = time.monotonic() + pause
                    try:
                        content, error = fetch(url), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"[:500]
                rows.append((url, content, error, n))
            yield pd.DataFrame(rows, columns=["url", "content", "error", "attempts"])

    return spread.mapInPandas(work, "url string, content binary, error string, attempts int")


def recognise_pages(pages: DataFrame, ladder: list[tuple[str, Recognise]], accept: float) -> DataFrame:
    """(document_id, page_no, text, mean_conf, engine, error) of pages with ``image`` and ``language``.

    Engines are tried in order until one is confident enough; the best result stands if none is. A missing
    engine is an error of the page, not an empty page.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, p, image, language in zip(b["document_id"], b["page_no"], b["image"], b["language"]):
                best, errors = (None, None, None), []
                for name, engine in ladder:
                    try:
                        text, conf = engine(image, language)
                    except Exception as e:  # noqa: BLE001
                        errors.append(f"{name}: {e}"[:200])
                        continue
                    if best[1] is None or conf > best[1]:
                        best = (text, conf, name)
                    if conf >= accept:
                        break
                rows.append((d, p, *best, "; ".join(errors) or None))
            yield pd.DataFrame(rows, columns=["document_id", "page_no", "text", "mean_conf", "engine", "error"])

    ship(pages.sparkSession)
    return pages.select("document_id", "page_no", "image", "language").mapInPandas(
        work, "document_id string, page_no int, text string, mean_conf double, engine string, error string"
    )


def adjudicate(windows: DataFrame, ask: Callable[[str], str], weight: float = 0.9, max_pages: int = 60) -> DataFrame:
    """(document_id, start_page, end_page, heading, score, error) of excerpts ``prompt`` judged by an injected model.

    The answer is a JSON object, alone or inside other text, with start_page, end_page, heading and
    confidence; what cannot be read, and a section said to be absent, gives null pages.
    """
    ship(windows.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for b in batches:
            rows = []
            for d, prompt in zip(b["document_id"], b["prompt"]):
                row = (d, None, None, None, None, None)
                try:
                    raw = ask(prompt)
                    told = json.loads(raw[raw.index("{") : raw.rindex("}") + 1])
                    s, e = int(told.get("start_page", -1)), int(told.get("end_page", -1))
                    if 0 <= s <= e:
                        row = (d, s, min(e, s + max_pages - 1), told.get("heading") or None, float(told.get("confidence", 0.6)) * weight, None)
                except Exception as x:  # noqa: BLE001
                    row = (d, None, None, None, None, f"{type(x).__name__}: {x}"[:300])
                rows.append(row)
            out = pd.DataFrame(rows, columns=["document_id", "start_page", "end_page", "heading", "score", "error"])
            yield out.astype({"start_page": "Int32", "end_page": "Int32"})

    return windows.select("document_id", "prompt").mapInPandas(work, "document_id string, start_page int, end_page int, heading string, score double, error string")


def unzip_largest(files: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """(path, name, content): the largest member with the suffix of each archive; broken archives give null."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    top = max((i for i in z.infolist() if i.filename.lower().endswith(suffix)), key=lambda i: (i.file_size, i.filename))
                    rows.append((path, top.filename, z.read(top)))
                except (zipfile.BadZipFile, ValueError, TypeError):
                    rows.append((path, None, None))
            yield pd.DataFrame(rows, columns=["path", "name", "content"])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(work, "path string, name string, content binary")
