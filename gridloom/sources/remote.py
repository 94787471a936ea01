"""Objects read by URL: what is wanted is a row, what became of it is another."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Statuses that may pass by themselves, tries, and seconds before the second try.
PASSING = frozenset({408, 425, 429, 500, 502, 503, 504})
TRIES, PAUSE = 6, 2.0


class Unreadable(OSError):
    """No further try would bring the object."""


class Drifted(Unreadable):
    """The object is another one than the inventory's, which ends a run."""


@dataclass(frozen=True)
class Wanted:
    """An object, or ``length`` bytes of it from ``start`` on, or with ``bare`` only what is
    known about it; and what the inventory says of it."""

    url: str
    start: int = 0
    length: int | None = None
    bare: bool = False
    etag: str | None = None
    size: int | None = None

    def request(self) -> urllib.request.Request:
        span = {} if self.length is None else {"Range": f"bytes={self.start}-{self.start + self.length - 1}"}
        return urllib.request.Request(self.url, method="HEAD" if self.bare else "GET", headers=span)

    def checked(self, body: bytes, facts: dict[str, str]) -> "Got":
        """The answer, if it is the inventory's object. Servers that ignore a range send all."""
        found = facts.get("etag")
        if self.etag and found and found != self.etag:
            raise Drifted(f"{self.url}: etag {found}, not {self.etag}")
        told = int(facts.get("content-length", -1))
        if self.length is not None:
            body = body[: self.length]
        elif self.size is not None and self.size >= 0 and (told if self.bare else len(body)) != self.size:
            raise Drifted(f"{self.url}: {told if self.bare else len(body)} bytes, not {self.size}")
        return Got(body, told if self.bare else len(body), found, facts.get("last-modified"))


@dataclass(frozen=True)
class Got:
    body: bytes
    size: int
    etag: str | None
    modified: str | None


def may_pass(failure: Exception) -> bool:
    """Whether a failed try is worth another: a passing status, or a broken connection."""
    if isinstance(failure, urllib.error.HTTPError):
        return failure.code in PASSING
    return isinstance(failure, (urllib.error.URLError, TimeoutError, ConnectionError))


def pauses(tries: int = TRIES, first: float = PAUSE) -> Iterator[float]:
    """Seconds to wait before each further try: doubling, and never in step with others."""
    for k in range(tries - 1):
        yield first * 2**k * random.uniform(0.5, 1.5)


@dataclass
class Pace:
    """Starts at least ``gap`` seconds apart; nothing waits before the first."""

    gap: float = 0.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    free: float = float("-inf")

    def keep(self) -> None:
        if (early := self.free - self.clock()) > 0:
            self.sleep(early)
        self.free = max(self.clock(), self.free) + self.gap


def read(wanted: Wanted, send: Callable = urllib.request.urlopen, pace: Pace | None = None, sleep: Callable[[float], None] = time.sleep) -> Got:
    """The answer to one request, tried again as long as that may help."""
    left = pauses()
    while True:
        if pace:
            pace.keep()
        try:
            with send(wanted.request()) as answer:
                return wanted.checked(b"" if wanted.bare else answer.read(), {k.lower(): v for k, v in dict(answer.headers).items()})
        except Drifted:
            raise
        except Exception as failure:
            if not may_pass(failure):
                if isinstance(failure, urllib.error.HTTPError):
                    raise Unreadable(f"{wanted.url}: status {failure.code}") from failure
                raise
            if (pause := next(left, None)) is None:
                raise Unreadable(f"{wanted.url}: {failure} after {TRIES} tries") from failure
        sleep(pause)


def read_text(url: str) -> str:
    return read(Wanted(url)).body.decode("utf-8", "replace")


@dataclass
class _Share(InputPartition):
    rows: list[tuple[int, str]]


class _UrlReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        listed = [u for u in options.get("urls", "").split("\n") if u]
        many = max(1, min(int(options.get("partitions", "8")), len(listed)))
        self.shares = [_Share(list(enumerate(listed))[k::many]) for k in range(many)]
        self.length = int(options.get("bytes", "0")) or None
        self.gap = many / float(options["perSecond"]) if "perSecond" in options else 0.0

    def partitions(self) -> list[InputPartition]:
        return self.shares

    def read(self, partition: _Share) -> Iterator[tuple]:
        pace = Pace(self.gap)
        for ordinal, url in partition.rows:
            try:
                yield ordinal, url, read(Wanted(url, length=self.length), pace=pace).body, None
            except Drifted:
                raise
            except OSError as e:
                yield ordinal, url, None, str(e)


class UrlSource(DataSource):
    """``spark.read.format("urls")``: options ``urls`` (one a line), ``partitions`` (the number
    of polite connections), ``bytes`` (read only the first), ``perSecond`` (over all)."""

    @classmethod
    def name(cls) -> str:
        return "urls"

    def schema(self) -> str:
        return "ordinal bigint, url string, content binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return _UrlReader(dict(self.options))


def read_urls(spark: SparkSession, urls: list[str], partitions: int = 8, first_bytes: int = 0, per_second: float | None = None) -> DataFrame:
    """The objects of some URLs with their ordinals; a failed one is a row with its error."""
    spark.dataSource.register(UrlSource)
    reader = spark.read.format("urls").option("urls", "\n".join(urls)).option("partitions", partitions).option("bytes", first_bytes)
    return (reader.option("perSecond", per_second) if per_second else reader).load()


def fetch_column(
    df: DataFrame,
    url_col: str,
    partitions: int = 8,
    first_bytes: int = 0,
    etag_col: str | None = None,
    size_col: str | None = None,
    per_second: float | None = None,
    send: Callable = urllib.request.urlopen,
) -> DataFrame:
    """``df`` with ``content`` and ``error`` for the URL of each row, over a bounded number of
    connections that keep ``per_second`` together; an ``ordinal`` column of ``df`` restores the
    order. Where ``etag_col`` and ``size_col`` name what the inventory says, an object that is
    another one ends the job with ``Drifted``; every other failure is its row's error."""
    base = df.drop("content", "error")
    at, etag_at, size_at = (None if c is None else base.columns.index(c) for c in (url_col, etag_col, size_col))
    gap = partitions / per_second if per_second else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(gap)
        for b in batches:
            held = lambda k: [None] * b.num_rows if k is None else b.column(k).to_pylist()  # noqa: E731, B023
            bodies, errors = [], []
            for url, etag, size in zip(held(at), held(etag_at), held(size_at)):
                body, error = None, "no url" if url is None else None
                if url is not None:
                    try:
                        body = read(Wanted(url, length=first_bytes or None, etag=etag, size=size), send, pace).body
                    except Drifted:
                        raise
                    except OSError as e:
                        error = str(e)
                bodies.append(body)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bodies, pa.binary()), pa.array(errors, pa.string())], names=[*b.schema.names, "content", "error"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "content binary", "error string"])
    return base.repartition(partitions).mapInArrow(run, schema)
