"""Calls of web services: POST of JSON with retries and tokens, as a data source and as a map; discovery of hosts; files by url."""

from __future__ import annotations

import json
import re
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Answers by which a service asks for a new token, and its word for success.
STALE, SUCCESS = ("Time out.", "no token."), "1"
AGENT = "Mozilla/5.0 (rallyframe)"


def loads(text: str):
    """JSON with raw control characters inside texts, as services send it."""
    return json.loads(text, strict=False)


class Poster:
    """POSTs payloads to ``url``; with ``token``, a payload that asks for one, every payload carries it, and a stale one is renewed.

    A failing call is repeated up to ``attempts`` times, after a pause that grows by ``pause`` seconds each time.  Any two calls,
    those for tokens and repeated ones included, begin at least ``every`` seconds apart.
    """

    def __init__(self, url: str, origin: str = "", agent: str = AGENT, token: str = "", attempts: int = 3, timeout: float = 30, pause: float = 1.5, every: float = 0):
        self.url, self.origin, self.agent, self.ask = url, origin, agent, token
        self.attempts, self.timeout, self.pause = int(attempts), float(timeout), float(pause)
        self.every, self.due = float(every), 0.0
        self.token: str | None = None

    def _wait(self) -> None:
        time.sleep(max(0.0, self.due - time.monotonic()))
        self.due = time.monotonic() + self.every

    def _post(self, payload: dict) -> str:
        headers = {"Content-Type": "application/json", "User-Agent": self.agent}
        if self.origin:
            headers |= {"Origin": self.origin, "Referer": self.origin + "/"}
        for attempt in range(1, self.attempts + 1):
            self._wait()
            try:
                request = urllib.request.Request(self.url, json.dumps(payload, ensure_ascii=False).encode(), headers, method="POST")
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    text = answer.read().decode("utf-8", "replace")
                loads(text)
                return text
            except (OSError, ValueError):
                if attempt == self.attempts:
                    raise
                time.sleep(self.pause * attempt)
        raise AssertionError

    def _renew(self) -> None:
        answer = loads(self._post(loads(self.ask)))
        if answer.get("success") != SUCCESS:
            raise ValueError(f"no token: {answer}")
        self.token = answer["result"]

    def post(self, payload: str) -> str:
        if not self.ask:
            return self._post(loads(payload))
        if self.token is None:
            self._renew()
        answer = self._post(loads(payload) | {"token": self.token})
        if loads(answer).get("result") in STALE:
            self._renew()
            answer = self._post(loads(payload) | {"token": self.token})
        return answer

    def answered(self, payload: str) -> tuple[str | None, str | None]:
        """The answer, or what went wrong."""
        try:
            return self.post(payload), None
        except (OSError, ValueError) as error:
            return None, f"{type(error).__name__}: {error}"


def answers(payloads: DataFrame, url: str, every: float = 0, callers: int = 1, **options) -> DataFrame:
    """``payloads`` with ``answer`` and ``error`` of a POST of each ``payload``.

    With ``every``, the rows are dealt to ``callers`` tasks, each with a token of its own, that together begin a call every so many seconds
    on average; without it, calls run at once in the tasks that hold the rows.  One failing call fails its row only.  Lost tasks
    call again, so land the answers before they are used.
    """
    if every:
        payloads, options = payloads.repartition(callers), options | {"every": every * callers}
    names = payloads.columns
    at = names.index("payload")

    def run(batches: Iterator[pa.RecordBatch]):
        poster = Poster(url, **options)
        for batch in batches:
            got = [poster.answered(p) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([a for a, _ in got], type=pa.string()), pa.array([e for _, e in got], type=pa.string())], names=[*names, "answer", "error"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in payloads.schema)
    return payloads.mapInArrow(run, f"{kept}, answer string, error string")


class _Calls(InputPartition):
    def __init__(self, payloads: list[str], round: int = 0):
        self.payloads, self.round = payloads, round


class _Payloads:
    """Options of the data sources: those of ``Poster``, ``payloads`` a line each, and ``callers`` if calls have pauses."""

    def __init__(self, options: dict):
        names = ("url", "origin", "agent", "token", "attempts", "timeout", "pause", "every")
        self.options = {k: v for k, v in options.items() if k in names}
        self.payloads = options.get("payloads", "{}").split("\n")
        self.callers = len(self.payloads)
        if every := float(options.get("every", 0)):
            self.callers = int(options.get("callers", 1))
            self.options["every"] = every * self.callers

    def dealt(self, round: int = 0) -> list[_Calls]:
        return [_Calls(part, round) for i in range(self.callers) if (part := self.payloads[i :: self.callers])]

    def answered(self, partition: _Calls):
        poster = Poster(**self.options)
        for payload in partition.payloads:
            yield payload, *poster.answered(payload)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.calls = _Payloads(options)

    def partitions(self):
        return self.calls.dealt()

    def read(self, partition):
        yield from self.calls.answered(partition)


class PayloadSource(DataSource):
    """``spark.read.format("rally_api").option("url", ...).option("payloads", ...)``: (payload, answer, error).

    Without ``every`` each call has a partition; with it ``callers`` partitions share the pauses.
    """

    @classmethod
    def name(cls) -> str:
        return "rally_api"

    def schema(self) -> str:
        return "payload string, answer string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Poll(DataSourceStreamReader):
    """Offsets are numbers of periods, so they need no memory: a restart within a polled period calls nothing."""

    def __init__(self, options: dict):
        self.calls, self.period = _Payloads(options), float(options.get("period", 3600))

    def _now(self) -> int:
        return int(time.time() // self.period)

    def initialOffset(self) -> dict:
        return {"round": self._now() - 1}

    def latestOffset(self) -> dict:
        return {"round": self._now()}

    def partitions(self, start: dict, end: dict):
        # periods that passed while nobody polled are polled once
        return self.calls.dealt(end["round"]) if end["round"] > start["round"] else []

    def read(self, partition):
        for row in self.calls.answered(partition):
            yield partition.round, *row

    def commit(self, end: dict) -> None:
        pass


class PollSource(DataSource):
    """``spark.readStream.format("rally_poll")`` with the options of ``rally_api`` and ``period``: (round, payload, answer, error).

    Every ``period`` seconds all payloads are asked once, with pauses as told by ``every``.  A batch that is committed is not asked again
    after a restart; one that failed before is.
    """

    @classmethod
    def name(cls) -> str:
        return "rally_poll"

    def schema(self) -> str:
        return "round long, payload string, answer string, error string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Poll(self.options)


def origin_of(url: str) -> str:
    return m[1] if (m := re.match("(https?://[^/]+)", url)) else ""


def discovered(url: str, folder: str, fallback: str, timeout: float = 30) -> str:
    """The base ``scheme://host/folder`` that ``url`` redirects to, or ``fallback`` if it cannot be told."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
            m = re.match(f"(https?://[^/]+/{re.escape(folder)})/", answer.geturl() + "/")
            return m[1] if m else fallback
    except OSError:
        return fallback


def fetched_files(urls: DataFrame, timeout: float = 60) -> DataFrame:
    """(url, name, length, content) of files by ``url``; characters that a url cannot hold are quoted."""

    def run(batches):
        for batch in batches:
            for url in batch.column(0).to_pylist():
                request = urllib.request.Request(urllib.parse.quote(url, safe=":/%?=&"), headers={"User-Agent": AGENT})
                with urllib.request.urlopen(request, timeout=timeout) as answer:
                    content = answer.read()
                yield pa.RecordBatch.from_pydict({"url": [url], "name": [url.rsplit("/", 1)[-1]], "length": pa.array([len(content)], type=pa.int64()), "content": [content]})

    return urls.select("url").mapInArrow(run, "url string, name string, length long, content binary")
