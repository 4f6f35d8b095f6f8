"""Harness for external kernels (media tools, models, endpoints): rows in, rows with an ok flag and an error text out."""

from __future__ import annotations

import asyncio
import contextlib
from collections import deque
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Provider(Protocol):
    """Made once a partition; gets rows as dicts and gives one dict each."""

    def process_batch(self, rows: list[dict]) -> list[dict]: ...


def apply_provider(df: DataFrame, make: Callable[[], Provider], fields: T.StructType, prefix: str, batch: int = 128) -> DataFrame:
    """df with the provider's fields, <prefix>_ok (1 or 0) and <prefix>_error.

    A batch that fails, or comes back with another length, is retried row by row, so that one bad row costs
    only itself.
    """
    schema, good, bad, filled = _results(df, fields, prefix)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()

        def one(row: dict) -> dict:
            try:
                (got,) = provider.process_batch([row])
                return good(got)
            except Exception as e:  # a worker's error is data of its row
                return bad(str(e))

        for pdf in frames:
            out = []
            rows = pdf.to_dict("records")
            for at in range(0, len(rows), batch):
                part = rows[at : at + batch]
                try:
                    got = provider.process_batch(part)
                    if len(got) != len(part):
                        raise ValueError("batch of another length")
                    out += [good(g) for g in got]
                except Exception:
                    out += [one(r) for r in part]
            yield filled(pdf, out)

    return df.mapInPandas(run, schema)


def _results(df: DataFrame, fields: T.StructType, prefix: str) -> tuple[T.StructType, Callable, Callable, Callable]:
    """The schema with a provider's fields, flag and error; results of an answer and of an error; rows filled with their results."""
    names, ok, error = [f.name for f in fields], f"{prefix}_ok", f"{prefix}_error"
    kept = [f for f in df.schema if f.name not in {*names, ok, error}]
    schema = T.StructType([*kept, *fields, T.StructField(ok, T.LongType()), T.StructField(error, T.StringType())])

    def good(got: dict) -> dict:
        return {**{n: got.get(n) for n in names}, ok: 1, error: ""}

    def bad(why: str) -> dict:
        return {**dict.fromkeys(names), ok: 0, error: why}

    def filled(pdf: pd.DataFrame, out: list[dict]) -> pd.DataFrame:
        for c in (*names, ok, error):
            pdf[c] = pd.Series([o[c] for o in out], index=pdf.index, dtype=object if c in names else None)
        return pdf[[f.name for f in schema]]

    return schema, good, bad, filled


class AsyncProvider(Protocol):
    """Made once a task, for its endpoint, inside the task's event loop; answers one row at a time. close() is called in the end, if there is one."""

    async def process_one(self, row: dict) -> dict: ...


def apply_async_provider(
    df: DataFrame, make: Callable[[str], AsyncProvider], fields: T.StructType, prefix: str, endpoints: list[str],
    concurrency: int = 16, timeout_sec: float | None = None, retries: int = 0, needs: tuple[str, str] | None = None, ahead: int = 8,
) -> DataFrame:
    """df with the answers of asynchronous endpoints, <prefix>_ok (1 or 0) and <prefix>_error, rows of a partition in their order.

    Rows are dealt evenly to as many partitions as there are endpoints, so that each endpoint is asked by one task, which has up
    to `concurrency` requests open at any time: up to `ahead` further batches are sent while earlier ones are waited for. A request that
    fails is sent again `retries` times; then, or if it takes over `timeout_sec`, the error is data of its row. With
    `needs` (flag, error), rows whose flag is not 1 are not sent and carry that error over.
    """
    if not endpoints or concurrency <= 0 or retries < 0:
        raise ValueError("endpoints, a positive concurrency and no negative retries are needed")
    schema, good, bad, filled = _results(df, fields, prefix)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        endpoint = endpoints[TaskContext.get().partitionId() % len(endpoints)]
        loop = asyncio.new_event_loop()
        gate = asyncio.Semaphore(concurrency)
        open_: set[asyncio.Task] = set()
        waiting: deque[tuple[pd.DataFrame, list[asyncio.Task]]] = deque()

        async def made() -> AsyncProvider:
            return make(endpoint)

        async def one(row: dict) -> dict:
            if needs is not None and row[needs[0]] != 1:
                return bad(str(row[needs[1]] or ""))
            async with gate:
                for left in reversed(range(retries + 1)):
                    try:
                        return good(await asyncio.wait_for(provider.process_one(row), timeout_sec))
                    except TimeoutError:
                        why = f"no answer within {timeout_sec} s" if timeout_sec else "no answer in time"
                    except Exception as e:  # an endpoint's error is data of its row
                        why = str(e) or type(e).__name__
                    if not left:
                        return bad(why)

        async def until(most: int) -> None:
            """Waits until no more than so many requests are open."""
            while len(open_) > most:
                done, _ = await asyncio.wait(open_, return_when=asyncio.FIRST_COMPLETED)
                open_.difference_update(done)

        async def sent(rows: list[dict]) -> list[asyncio.Task]:
            return [asyncio.create_task(one(r)) for r in rows]

        try:
            provider = loop.run_until_complete(made())
            for pdf in frames:
                tasks = loop.run_until_complete(sent(pdf.to_dict("records")))
                open_.update(tasks)
                waiting.append((pdf, tasks))
                # enough stays open to keep the endpoint busy while the next rows come in
                loop.run_until_complete(until(concurrency))
                if len(waiting) > ahead:
                    loop.run_until_complete(asyncio.wait(waiting[0][1]))
                while waiting and all(t.done() for t in waiting[0][1]):
                    ready, tasks = waiting.popleft()
                    yield filled(ready, [t.result() for t in tasks])
            loop.run_until_complete(until(0))
            while waiting:
                ready, tasks = waiting.popleft()
                yield filled(ready, [t.result() for t in tasks])
        finally:
            for t in open_:
                t.cancel()
            with contextlib.suppress(Exception):
                loop.run_until_complete(asyncio.gather(*open_, return_exceptions=True))
                if hasattr(provider, "close"):
                    loop.run_until_complete(provider.close())
            loop.close()

    return df.repartition(len(endpoints)).mapInPandas(run, schema)


class Encoder(Protocol):
    """Turns clips into training samples: gets the rows of one batch, all of one bucket, and gives one dict of the encoder's fields for each."""

    #: Widths and heights are multiples of it.
    size_multiple: int

    def encode_batch(self, frames: int, width: int, height: int, rows: list[dict]) -> list[dict]: ...


def apply_encoder(df: DataFrame, make: Callable[[], Encoder], fields: T.StructType, prefix: str, bucket: tuple[str, str, str], batch: int = 8) -> DataFrame:
    """df with the fields of an encoder, <prefix>_ok and <prefix>_error; `bucket` names the columns of frames, width and height.

    Rows are sorted by bucket within their partitions, so that batches are of one bucket; no shuffle. Sizes that are null, not positive or no
    multiples of the encoder's are errors of their rows. A batch that fails, or comes back with another length, is retried row by row.
    """
    schema, good, bad, filled = _results(df, fields, prefix)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make()

        def encoded(key: tuple, rows: list[dict]) -> list[dict]:
            try:
                got = encoder.encode_batch(*key, rows)
                if len(got) != len(rows):
                    raise ValueError("batch of another length")
                return [good(g) for g in got]
            except Exception as e:
                return [bad(str(e))] if len(rows) == 1 else [x for r in rows for x in encoded(key, [r])]

        for pdf in frames:
            rows, out, at = pdf.to_dict("records"), [], 0
            while at < len(rows):
                key = tuple(rows[at][c] for c in bucket)
                sizes = [int(v) if v == v and v is not None and v > 0 else 0 for v in key]
                if not all(sizes) or any(v % encoder.size_multiple for v in sizes[1:]):
                    out.append(bad(f"no size of the encoder: {key[0]} frames of {key[1]}x{key[2]}"))
                    at += 1
                    continue
                stop = at + 1
                while stop < min(len(rows), at + batch) and tuple(rows[stop][c] for c in bucket) == key:
                    stop += 1
                out += encoded(tuple(sizes), rows[at:stop])
                at = stop
            yield filled(pdf, out)

    return df.sortWithinPartitions(*bucket).mapInPandas(run, schema)
