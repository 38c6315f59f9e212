"""Remote sources behind a fetch function, so that they run and are tested without a network.

`fetch(request) -> bytes | None` is called on executors. Requests that share a rate limit go through
one partition, which waits between calls; what exists already is left out by an anti-join before.
"""

from __future__ import annotations

import io
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str], bytes | None]
#: Seconds between calls, without and with a key, as the public service asks.
DELAY, DELAY_WITH_KEY = 0.34, 0.10


def package_entry(content: bytes | None, suffix: str = "protein.faa") -> str | None:
    """The first entry of a zip package that ends with a suffix; None for anything unusable."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as package:
            name = next((n for n in package.namelist() if n.endswith(suffix)), None)
            return None if name is None else package.read(name).decode("utf-8")
    except zipfile.BadZipFile:
        return None


def package_entries(content: bytes | None, suffix: str = "protein.faa") -> list[tuple[str, str]]:
    """(folder, text) of all entries that end with a suffix, the folder being the one they lie in."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as package:
            return [(n.split("/")[-2] if "/" in n else "", package.read(n).decode("utf-8")) for n in package.namelist() if n.endswith(suffix)]
    except zipfile.BadZipFile:
        return []


def plain_text(content: bytes | None) -> str | None:
    """A text body, such as FASTA or a structure file; None for none."""
    return content.decode("utf-8") if content else None


def http_fetch(url: str, timeout: float = 60.0) -> Fetch:
    """A fetch by GET; `{}` in the address becomes the quoted request. What the service does not have is None."""

    def fetch(request: str) -> bytes | None:
        try:
            with urllib.request.urlopen(url.replace("{}", urllib.parse.quote(request, safe=",")), timeout=timeout) as body:
                return body.read()
        except urllib.error.HTTPError as error:
            if error.code in (404, 410):
                return None
            raise

    return fetch


def page_fetch(url: str, timeout: float = 60.0) -> Callable[[str | None], bytes]:
    """A fetch of report pages by GET, the token of a page as page_token."""

    def fetch(token: str | None) -> bytes:
        more = "" if token is None else ("&" if "?" in url else "?") + urllib.parse.urlencode({"page_token": token})
        with urllib.request.urlopen(url + more, timeout=timeout) as body:
            return body.read()

    return fetch


def _paced(requests, fetch: Fetch, pause: float, decode: Callable) -> Iterator[tuple[object | None, str | None]]:
    """Decoded bodies and errors of calls that keep a pause between them; an error of a call, or of
    decoding what it brought, ends that call alone."""
    last = float("-inf")
    for request in requests:
        time.sleep(max(0.0, last + pause - time.monotonic()))
        last = time.monotonic()
        try:
            got = decode(fetch(request)), None
        except Exception as error:  # noqa: BLE001  whatever a service does, the other calls go on
            got = None, f"{type(error).__name__}: {error}"
        yield got


def download(wanted: DataFrame, existing: DataFrame, fetch: Fetch, with_key: bool = False, lanes: int = 1, decode: Callable[[bytes | None], str | None] = package_entry) -> DataFrame:
    """(accession, content, error) of wanted accessions that do not exist yet. Each lane keeps the
    delay; content is null where there is none or the call failed, which its error tells."""
    pause = (DELAY_WITH_KEY if with_key else DELAY) * lanes

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = list(_paced(frame["accession"], fetch, pause, decode))
            yield pd.DataFrame({"accession": frame["accession"], "content": [c for c, _ in got], "error": [e for _, e in got]}, dtype=object)

    missing = wanted.select("accession").distinct().join(existing.select("accession"), "accession", "left_anti")
    return missing.repartition(lanes).mapInPandas(run, "accession string, content string, error string")


def bulk_download(batches: DataFrame, fetch: Fetch, suffix: str = "protein.faa", with_key: bool = False) -> DataFrame:
    """(chunk, accession, content, error) of batches (chunk, accessions): one call each for a package
    of many accessions, a row for each entry. A call that fails or brings nothing is one row with its
    error, and the next goes on."""
    pause = DELAY_WITH_KEY if with_key else DELAY

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for chunk, (found, error) in zip(frame["chunk"], _paced(frame["accessions"], fetch, pause, lambda body: package_entries(body, suffix)), strict=True):
                rows += [(chunk, name, text, None) for name, text in found or []] or [(chunk, None, None, error or "no entry")]
            yield pd.DataFrame(rows, columns=["chunk", "accession", "content", "error"], dtype=object)

    return batches.select("chunk", "accessions").repartition(1).mapInPandas(run, "chunk long, accession string, content string, error string")


def local_packages(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content): the protein entry of each zip package of a folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "content": [content for content, _ in _paced(frame["content"], lambda c: c, 0.0, package_entry)]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "content").mapInPandas(run, "path string, content string")


class ReportPages(DataSource):
    """Pages of a report service that name the next page; stops early at `limit` accessions.

    Options: limit, and a `fetch` set on the class before it is registered."""

    fetch: Callable[[str | None], dict] = staticmethod(lambda token: {})

    @classmethod
    def name(cls) -> str:
        return "report_pages"

    def schema(self) -> str:
        return "page int, pos int, accession string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(type(self).fetch, self.options.get("limit"))


class _PageReader(DataSourceReader):
    def __init__(self, fetch, limit):
        self.fetch, self.limit = fetch, None if limit in (None, "all") else int(limit)

    def partitions(self):
        return [InputPartition(0)]  # each page's token comes from the page before

    def read(self, partition):
        token, page, given = None, 0, 0
        while self.limit is None or given < self.limit:
            body = self.fetch(token)
            body = json.loads(body) if isinstance(body, (str, bytes)) else body
            for pos, report in enumerate(body.get("reports", [])):
                if report.get("accession") is None or (self.limit is not None and given >= self.limit):
                    continue
                given += 1
                yield page, pos, report["accession"]
            token, page = body.get("next_page_token"), page + 1
            if not token:
                return
