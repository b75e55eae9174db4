"""Where the engine meets the outside: page fetching, text recognition, page capture and PDF reading.

Each is a plain function of one key to a dict, called on Arrow batches in `answered`; results must be written
before they branch, so that a retried task doesn't call again for what is done. The doubles serve tests.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Answer = Callable[[dict], dict]


def outcome(call: Answer, row: dict) -> dict:
    """The answer, or an error in one of the fixed wordings."""
    try:
        return call(row)
    except TimeoutError:
        return {"error": "Timeout"}
    except ConnectionError as e:
        code = getattr(e, "status_code", None)
        return {"error": f"HTTP Error: {code}", "status_code": code} if code else {"error": f"Network Error: {e}"}
    except Exception as e:  # noqa: BLE001
        return {"error": f"Unexpected Error: {e}"}


def retried(call: Answer, times: int = 3, statuses: tuple[int, ...] = (500, 502, 503, 504), backoff: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """`call`, again if it fails with one of `statuses`; the wait doubles with each try."""

    def again(row: dict) -> dict:
        for left in range(times, -1, -1):
            try:
                return call(row)
            except ConnectionError as e:
                if not left or getattr(e, "status_code", None) not in statuses:
                    raise
                sleep(backoff * 2 ** (times - left))
        raise AssertionError

    return again


def answered(requests: DataFrame, call: Answer, schema: str, parallel: int | None = None) -> DataFrame:
    """`requests` with the fields of the answers; `parallel` tasks call at a time at most."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    own = requests.columns

    def op(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers = [outcome(call, row) for row in pdf.to_dict("records")]
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame([{n: a.get(n) for n in names} for a in answers], columns=names)], axis=1)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    todo = requests.repartition(parallel) if parallel else requests
    return todo.mapInPandas(op, f"{ddl}, {schema}").select(*own, *names)


#: What a PDF reader gives: the links of the pages, in their order, and their blocks of text.
PDF_LINKS = "page int, link_no int, url string, rect array<double>"
PDF_BLOCKS = "page int, block_no int, rect array<double>, text string"


def read_from(files: DataFrame, read: Callable[[str, bytes | None], list[tuple]], schema: str) -> DataFrame:
    """(path, fields of `schema`) for each row that `read` makes of a file's path and content.

    `files` has path and content, as Spark's binaryFile gives. Files that aren't PDF, are missing (NULL
    content) or can't be read give no rows.
    """
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def op(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                if not str(path).lower().endswith(".pdf") or content is None:
                    continue
                try:
                    out += [(path, *row) for row in read(path, bytes(content))]
                except Exception:  # noqa: BLE001, S112
                    continue
            yield pd.DataFrame(out, columns=["path", *names])

    return files.select("path", "content").mapInPandas(op, f"path string, {schema}")


def page_double(pages: dict[str, dict]) -> Answer:
    """Answers from a dict by URL; unknown URLs are not found."""

    def call(row: dict) -> dict:
        if row["url"] not in pages:
            error = ConnectionError("not found")
            error.status_code = 404
            raise error
        return pages[row["url"]]

    return call
