"""URL filters on a sorted digest array.

Entries are strings of a host and the start of a path (``org/``, ``example.org/es/``).  Their 64-bit xxhash keys lie
sorted in one file, the full strings and what they say in others; executors fetch the files once each and their Python
workers map them into memory.  A URL is probed with every host suffix and path start whose number of labels and length occur
together among the entries: one vectorised binary search for a batch, then the stored string decides, so equal digests do
no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import quoted, shared_dir, ship, unused, without

#: What an entry says: a rule's verdict beats the list's.
RULE_ALLOW, RULE_BLOCK, LISTED = 0, 1, 2
#: Of equal entries a rule beats the list, and block beats allow.
STRENGTH = {LISTED: 0, RULE_ALLOW: 1, RULE_BLOCK: 2}
#: Every executor's disk holds the files, so a larger list is refused.
ARRAY_BYTES = 64 << 30
#: The parts of an array: file ending and element type.
PARTS = {"keys": np.uint64, "ends": np.int64, "kinds": np.uint8, "texts": np.uint8}
#: Seed of the digests, which Spark's ``xxhash64`` has too.
SEED = 42
_CHUNK = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def digest_of(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, SEED)


def sorted_entries(spark: SparkSession, entries: Iterable[tuple[str, int]] | DataFrame) -> Iterator[tuple[str, int]]:
    """Distinct entries by digest.  A table (entry, kind) of any size is sorted by Spark and comes one partition at a time."""
    if isinstance(entries, DataFrame):
        strength = F.create_map(*[F.lit(x) for pair in STRENGTH.items() for x in pair])
        best = entries.groupBy(F.col("entry").cast("string").alias("entry")).agg(F.max_by("kind", strength[F.col("kind")]).alias("kind"))
        yield from best.orderBy(F.xxhash64("entry").bitwiseXOR(F.lit(-(1 << 63))), "entry").toLocalIterator()
        return
    best: dict[str, int] = {}
    for entry, kind in entries:
        if entry not in best or STRENGTH[kind] > STRENGTH[best[entry]]:
            best[entry] = kind
    yield from sorted(best.items(), key=lambda e: (digest_of(e[0].encode()), e[0]))


class DigestArray:
    """Sorted 64-bit keys with their full strings, in files that are mapped, not read."""

    def __init__(self, path_of: Callable[[str], str], shapes: list[tuple[int, int]], digest=digest_of):
        """``path_of`` names the file of a part; ``shapes`` has the entries' pairs of host labels and path length, sorted."""
        part = lambda name: np.memmap(path_of(name), PARTS[name], "r")
        self.shapes, self.digest = shapes, digest
        self.keys, self.ends, self.kinds, self.texts = map(part, PARTS) if shapes else (np.zeros(0, t) for t in PARTS.values())

    @staticmethod
    def write(entries: Iterator[tuple[str, int]], open_part: Callable[[str], object], digest=digest_of) -> list[tuple[int, int]]:
        """Write sorted entries to the files that ``open_part`` opens, in chunks; the shapes."""
        shapes, size, rows = set(), 0, []
        with ExitStack() as stack:
            out = {name: stack.enter_context(open_part(name)) for name in PARTS}

            def flush() -> None:
                nonlocal size
                raw = [e.encode() for e, _ in rows]
                ends = size + np.cumsum([len(r) for r in raw], dtype=np.int64)
                for name, values in zip(PARTS, (np.array([digest(r) for r in raw], np.uint64), ends, np.array([k for _, k in rows], np.uint8), np.frombuffer(b"".join(raw), np.uint8))):
                    out[name].write(values.tobytes())
                size = int(ends[-1])
                rows.clear()

            n = 0
            for entry, kind in entries:
                host, slash, rest = entry.partition("/")
                if not slash:
                    raise ValueError(f"an entry needs a host and a path: {entry!r}")
                shapes.add((host.count(".") + 1, 1 + len(rest)))
                rows.append((entry, kind))
                n += 1
                if len(rows) == _CHUNK:
                    flush()
                    if size + 17 * n > ARRAY_BYTES:
                        raise ValueError(f"the digest array would be larger than {ARRAY_BYTES} bytes")
            if rows:
                flush()
        return sorted(shapes)

    def text(self, k: int) -> str:
        return self._raw(k).decode()

    def _raw(self, k: int) -> bytes:
        return self.texts[self.ends[k - 1] if k else 0 : self.ends[k]].tobytes()

    def find(self, texts: list[bytes]) -> np.ndarray:
        """The position of each text, or -1: binary search by digest, then the stored string."""
        digest = self.digest
        wanted = np.fromiter((digest(t) for t in texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, wanted)
        found = np.full(len(texts), -1, np.int64)
        open_ = np.arange(len(texts))
        while len(open_):
            open_ = open_[at[open_] < len(self.keys)]
            open_ = open_[self.keys[at[open_]] == wanted[open_]]
            again = []
            for i in open_.tolist():
                k = int(at[i])
                if self._raw(k) == texts[i]:
                    found[i] = k
                else:  # another string with this digest: look at the next
                    at[i] += 1
                    again.append(i)
            open_ = np.array(again, np.int64)
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str]]:
        """The longest fitting rule (then the longer host) and the verdict of each URL."""
        rows, probes = [], []
        most = max((labels for labels, _ in self.shapes), default=0)
        for i, (host, path) in enumerate(zip(hosts, paths)):
            if not path:
                continue
            tail = host.rsplit(".", most)
            for count, length in self.shapes:
                if count > len(tail):
                    break
                if length <= len(path):
                    rows.append(i)
                    probes.append((".".join(tail[-count:]) + path[:length]).encode())
        found = self.find(probes)
        rules: list[str | None] = [None] * len(hosts)
        verdicts = ["allow"] * len(hosts)
        best: list[tuple[int, int]] = [(0, 0)] * len(hosts)
        for p in np.flatnonzero(found >= 0).tolist():
            i, k = rows[p], int(found[p])
            kind, entry = int(self.kinds[k]), self.text(k)
            rank = (len(entry), entry.index("/"))
            if kind == LISTED:
                if rules[i] is None:
                    verdicts[i] = "block"
            elif rank > best[i]:
                best[i], rules[i] = rank, entry
                verdicts[i] = "block" if kind == RULE_BLOCK else "allow"
        return rules, verdicts


class _SharedFile:
    """A file to write on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)

    def write(self, raw: bytes) -> None:
        self.stream.write(bytearray(raw))

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.stream.close()


_MAPPED: dict[str, DigestArray] = {}


def _mapped(name: str, shapes: list[tuple[int, int]]) -> DigestArray:
    if name not in _MAPPED:
        _MAPPED.clear()
        _MAPPED[name] = DigestArray(lambda part: SparkFiles.get(f"{name}.{part}"), shapes)
    return _MAPPED[name]


def filter_urls(pages: DataFrame, entries: Iterable[tuple[str, int]] | DataFrame, url_col: str = "url") -> DataFrame:
    """All columns of ``pages`` plus ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (allow or block).

    The entries are pairs of a string and a kind, or a table (entry, kind) for lists that the driver cannot hold; their
    files are written in the shared folder.  An entry fits its host and all subdomains if the path of the URL starts with the
    entry's.  The longest rule decides (of equally long ones that with the longer host); without a rule a fitting list entry
    blocks, and all else is allowed.  Null URLs and URLs without ``://`` have an empty host and path and are allowed; URLs may
    have any length.  Repeated rows stay.  Input columns named host, path, rule or verdict (in any case) are replaced, also
    where one of them holds the URL.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    ship(spark)
    name = f"digests-{uuid.uuid4().hex}"
    at = f"{shared_dir(spark)}/{name}"
    shapes = DigestArray.write(sorted_entries(spark, entries), lambda part: _SharedFile(spark, f"{at}.{part}"))
    for part in PARTS if shapes else ():
        spark.sparkContext.addFile(f"{at}.{part}")  # an executor that joins later fetches it too

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def judge(host: pa.Array, path: pa.Array) -> pa.Array:
        rules, verdicts = _mapped(name, shapes).judge(host.to_pylist(), path.to_pylist())
        return pa.StructArray.from_arrays([pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    kept = without(pages, "host", "path", "rule", "verdict").columns
    (judged,) = unused((*kept, "host", "path"), "judged")
    url, columns = F.col(quoted(url_col)), [F.col(quoted(c)) for c in kept]
    parts = pages.select(*columns, url_host(url).alias("host"), url_path(url).alias("path"))
    return parts.select("*", judge("host", "path").alias(judged)).select(*columns, "host", "path", f"{judged}.rule", f"{judged}.verdict")
