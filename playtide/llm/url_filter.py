"""URL filters: rules as a sorted array of 64-bit digests, probed by binary search.

A rule is a host and the beginning of a path; it fits the host, all its subdomains and all
paths that start with its own. The rules' keys (``host/path``) are hashed with xxhash64 and
sorted; the array and the full strings behind it are mapped from one file per Python
worker. Every url is probed with each of its host suffixes joined with each prefix of its
path that is as long as some rule's path, all urls of a batch in one vectorised binary
search; a hit counts only if the stored string equals the probed one, so a collision of
digests decides nothing. The longest rule wins: the longest host, then the longest path.

The rules are a parameter, not a table: they are sent to the executors whole and must stay
below ``MOST_BYTES``; more raise an error.

Defined results: a url that is null or has no ``://`` has an empty host and path and no
rule; a url without a rule gets ``default``. Two equal rules with different verdicts raise.
Repeated rows are judged one by one; other columns are left out.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import ascii_lower

MOST_BYTES = 256 * 2**20
ROWS = 2_000


class Digests:
    """The sorted digests of rules and, in the same order, their strings and verdicts."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        keys: dict[bytes, str] = {}
        for verdict, host, path in rules:
            key = host.lower().encode() + b"/" + path.lstrip("/").encode()
            if keys.setdefault(key, verdict) != verdict:
                raise ValueError(f"two verdicts for {key.decode()}")
        hashed = sorted((xxhash.xxh64_intdigest(k), k) for k in keys)
        self.paths = sorted({len(k) - k.index(b"/") for k in keys})
        self.labels = max((k.split(b"/")[0].count(b".") + 1 for k in keys), default=0)
        ends = np.cumsum([0, *(len(k) for _, k in hashed)], dtype=np.int64)
        block = np.array([keys[k] == "block" for _, k in hashed], np.uint8)
        self.size = len(hashed)
        self.raw = np.array([h for h, _ in hashed], np.uint64).tobytes() + ends.tobytes() + block.tobytes() + b"".join(k for _, k in hashed)
        if len(self.raw) > MOST_BYTES:
            raise ValueError(f"the rules need {len(self.raw)} bytes; {MOST_BYTES} are sent to the executors at most")


class Mapped:
    """The array mapped from a file that has no name and goes with the process."""

    def __init__(self, raw: bytes, size: int):
        with tempfile.TemporaryFile() as file:
            file.write(raw or b"\0")
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n = size
        self.digests = np.frombuffer(self.map, np.uint64, n)
        self.ends = np.frombuffer(self.map, np.int64, n + 1, 8 * n) if raw else np.zeros(1, np.int64)
        self.block = np.frombuffer(self.map, np.uint8, n, 16 * n + 8) if raw else np.zeros(0, np.uint8)
        self.strings = 17 * n + 8

    def find(self, probes: list[bytes]) -> np.ndarray:
        """Place of each probed string in the array, -1 where it is not there."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.digests) or not probes:
            return out
        keys = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        at = np.searchsorted(self.digests, keys)
        hits = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == keys)
        for i in hits.tolist():
            k = int(at[i])
            while k < len(self.digests) and self.digests[k] == keys[i]:  # equal digests stand together
                if self.string(k) == probes[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def string(self, k: int) -> bytes:
        return self.map[self.strings + int(self.ends[k]) : self.strings + int(self.ends[k + 1])]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule and verdict of every row. ``rules``: (verdict, host, path)."""
    index = Digests(rules)
    shared = pages.sparkSession.sparkContext.broadcast((index.raw, index.size, index.paths, index.labels))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    parts = pages.select(F.col(page_id).alias("page_id"), rest.alias("_rest")).select(
        "page_id",
        ascii_lower(host).alias("host"),
        F.regexp_extract("_rest", r"^[^/?#]*(/?[^?#]*)", 1).alias("path"),
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, size, lengths, labels = shared.value
        found = Mapped(raw, size)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                probes, owner = [], []
                for row, (host, path) in enumerate(zip(part["host"].to_pylist(), part["path"].to_pylist())):
                    if not host:
                        continue
                    names, tail = host.encode().split(b"."), path.encode()
                    fits = [tail[:n] for n in reversed(lengths) if n <= len(tail)]
                    for k in range(max(0, len(names) - labels), len(names)):  # the longest host first
                        suffix = b".".join(names[k:])
                        probes += [suffix + f for f in fits]
                        owner += [row] * len(fits)
                at = found.find(probes)
                hit = np.flatnonzero(at >= 0)
                rows, first = np.unique(np.array(owner, np.int64)[hit], return_index=True)
                rule, verdict = [None] * part.num_rows, [default] * part.num_rows
                for row, k in zip(rows.tolist(), at[hit][first].tolist()):
                    rule[row], verdict[row] = found.string(k).decode(), "block" if found.block[k] else "allow"
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"]
                )

    kind = pages.schema[page_id].dataType.simpleString()
    return parts.mapInArrow(task, f"page_id {kind}, host string, path string, rule string, verdict string")
