"""SNK-07, SNK-10: calls of a model for each row, with retries and a breaker.

The model is any callable (request -> reply) that can be pickled: an HTTP client, or a table
of replies in tests. A row never fails the task: what went wrong is a column, by kind, so that
transient failures are tried again by a later run and final ones are recorded.
"""

from __future__ import annotations

import errno
import json
import os
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.schema import TRUNCATED
from leafmill.session import ship


class Rejected(Exception):
    """The server will not answer this request, however often it is asked."""


class Unavailable(Exception):
    """The server did not answer; it may later."""


class CutOff(str):
    """A reply that ended at its length limit."""


# Errors of a system call that are the system's, whatever file they name: no
# space or quota, a read-only or stale file system, no handles or memory left.
SYSTEM_ERRORS = ("ENOSPC", "EDQUOT", "EROFS", "ESTALE", "EMFILE", "ENFILE", "ENOMEM")
SYSTEM_ERRNOS = {getattr(errno, name) for name in SYSTEM_ERRORS if hasattr(errno, name)}


def system_error(e: BaseException, path: str | None = None) -> bool:
    """VAL-23: whether an error is the system's and not its input's: one of a system call, by
    its kind, or any while the file is there and can be read. A decoder's have no number."""
    if not isinstance(e, OSError) or e.errno is None:
        return False
    return e.errno in SYSTEM_ERRNOS or (path is not None and os.path.isfile(path) and os.access(path, os.R_OK))


class StopFlag:
    """STR-04: a file whose presence asks for no new requests. It lies where the driver and all
    executors see it; what is under way is finished and saved."""

    def __init__(self, path: str):
        self.path = path

    def set(self) -> None:
        with open(self.path, "a", encoding="utf-8"):
            pass

    def clear(self) -> None:
        if os.path.exists(self.path):
            os.remove(self.path)

    def __call__(self) -> bool:
        return os.path.exists(self.path)


class Caller:
    """Retries with doubled pauses; after `limit` requests in a row that found no server
    the rest fail at once, until one succeeds. Many threads may call."""

    def __init__(self, model: Callable[[str], str], retries: int = 3, pause: float = 2.0, limit: int = 4, stop: Callable[[], bool] | None = None):
        self.model, self.retries, self.pause, self.limit, self.stop = model, retries, pause, limit, stop
        self.misses, self._lock = 0, threading.Lock()

    def _count(self, missed: bool) -> None:
        with self._lock:
            self.misses = self.misses + 1 if missed else 0

    def __call__(self, request: str) -> tuple[str | None, str | None, str | None]:
        """(reply, kind of error, error). Before each attempt the stop flag and the breaker are
        looked at; only a success closes the breaker."""
        said = ""
        for k in range(self.retries + 1):
            if self.stop is not None and self.stop():
                return None, "stopped", "a stop was asked for"
            if self.misses >= self.limit:
                return None, "unavailable", "too many failures in a row"
            try:
                reply = self.model(request)
            except Rejected as e:
                return None, "rejected", str(e)[:300]
            except Exception as e:  # noqa: BLE001
                if not isinstance(e, (Unavailable, OSError)):
                    return None, "error", repr(e)[:300]
                said = str(e)[:300]
            else:
                self._count(False)
                return (f"{reply}\n{TRUNCATED}" if isinstance(reply, CutOff) else reply), None, None
            if k < self.retries:
                time.sleep(self.pause * 2**k)
        self._count(True)
        return None, "unavailable", said


class ChatEndpoint:
    """SNK-07: a model behind an HTTP endpoint of the usual chat form. A request is JSON: a text,
    or {"content": ..., "system": ..., and other fields of the body}. It can be pickled."""

    def __init__(self, url: str, model: str | None = None, timeout: float = 600.0, **body):
        self.url, self.model, self.timeout, self.body = url.rstrip("/"), model, timeout, {"max_tokens": 4096, "temperature": 0.0} | body

    def _ask(self, path: str, body: dict | None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        ask = urllib.request.Request(f"{self.url}{path}", data, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(ask, timeout=self.timeout) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            told = f"HTTP {e.code}: {e.read().decode(errors='replace')[:800]}"
            raise (Rejected if 400 <= e.code < 500 else Unavailable)(told) from e
        except (OSError, ValueError) as e:
            raise Unavailable(repr(e)) from e

    def first_model(self) -> str:
        """SRC-18: the first model that the endpoint lists; any error means that it is not there."""
        try:
            return self._ask("/models", None)["data"][0]["id"]
        except Rejected as e:
            raise Unavailable(str(e)) from e

    def __call__(self, request: str) -> str:
        if self.model is None:
            self.model = self.first_model()
        asked = json.loads(request) if request[:1] in "{[" else {"content": request}
        asked = asked if isinstance(asked, dict) else {"content": asked}
        system = [{"role": "system", "content": asked.pop("system")}] if asked.get("system") else []
        messages = [*system, {"role": "user", "content": asked.pop("content")}]
        choice = self._ask("/chat/completions", {"model": self.model, "messages": messages, **self.body, **asked})["choices"][0]
        text = choice["message"].get("content") or ""
        return CutOff(text) if choice.get("finish_reason") == "length" else text


def answered(rows: DataFrame, model: Callable[[str], str], workers: int = 32, **how) -> DataFrame:
    """rows (with a request) with reply, error_kind and error. A partition has one caller
    and so many requests in flight; order and rows stay as they are."""
    ship(rows.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = Caller(model, **how)
        with ThreadPoolExecutor(workers) as pool:
            for f in frames:
                got = list(pool.map(call, f["request"]))
                yield f.assign(reply=[g[0] for g in got], error_kind=[g[1] for g in got], error=[g[2] for g in got])

    schema = StructType(list(rows.schema.fields))
    for name in ("reply", "error_kind", "error"):
        schema = schema.add(name, "string")
    return rows.mapInPandas(run, schema)


def split_outcomes(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Answered, to be tried again, and dead letters (SNK-04)."""
    kind = F.col("error_kind")
    return rows.where(kind.isNull()), rows.where(kind.isin("unavailable", "stopped")), rows.where(kind.isin("rejected", "error"))
