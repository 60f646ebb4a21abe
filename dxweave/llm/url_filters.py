"""Operator 5: URL rules in a sorted array of digests, probed by vectorised binary search."""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common

#: The rules of the query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Largest index that is sent to the workers; a longer list must be given in several calls.
MAX_INDEX_BYTES = 256 << 20

SCHEMA = "page_id long, host string, path string, rule string, verdict string"


class RuleIndex:
    """Digests of the rules in order, with the full strings beside them."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        verdicts = {f"{host.lower()}{path}": verdict for verdict, host, path in rules}
        keys = {name: xxhash.xxh64_intdigest(name.encode()) for name in verdicts}
        names = sorted(verdicts, key=lambda n: (keys[n], n))
        raw = [n.encode() for n in names]
        self.digests = np.array([keys[n] for n in names], np.uint64).tobytes()
        self.ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        self.strings = b"".join(raw)
        self.verdicts = [verdicts[n] for n in names]
        #: Path lengths that occur in rules: how long a prefix of a URL's path has to be looked up.
        self.path_lengths = sorted({len(n) - n.index("/") for n in names if "/" in n} | {0 for n in names if "/" not in n})
        if len(self.digests) + len(self.strings) > MAX_INDEX_BYTES:
            raise ValueError("the rule list is larger than MAX_INDEX_BYTES; split it over several calls")

    def __len__(self) -> int:
        return len(self.verdicts)

    def name(self, i: int) -> bytes:
        return self.strings[self.ends[i - 1] if i else 0 : self.ends[i]]

    def mapped(self) -> np.ndarray:
        """The digests as a memory-mapped file of this machine; the file has no name left once it is mapped."""
        if not self.digests:
            return np.zeros(0, np.uint64)
        with tempfile.TemporaryFile() as file:
            file.write(self.digests)
            file.flush()
            return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint64)

    def probe(self, digests: np.ndarray, names: list[bytes]) -> np.ndarray:
        """Place of each name in the list or -1.  Equal digests are told apart by the strings."""
        if not len(self):
            return np.full(len(names), -1)
        low = np.searchsorted(digests, wanted := np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names)))
        out = np.full(len(names), -1)
        hit = low < len(self)
        hit[hit] = digests[low[hit]] == wanted[hit]
        for k in np.flatnonzero(hit):
            i = int(low[k])
            while i < len(self) and digests[i] == wanted[k]:
                if self.name(i) == names[k]:
                    out[k] = i
                    break
                i += 1
        return out


_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_FOLD = str.maketrans(_UPPER.decode(), _LOWER.decode())


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both empty for a null url or one without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((p for p in map(rest.find, "/?#") if p >= 0), default=len(rest))
    host, rest = rest[:end].translate(_FOLD), rest[end:]
    return host, rest.split("?", 1)[0].split("#", 1)[0]


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    default: str = "allow",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A rule (verdict, host, path) fits its host and all subdomains if the path of the url starts with
    the rule's.  The longest fitting rule wins, of equally long ones that with the longer host; a rule given
    twice counts as given last.  Each url asks for all suffixes of its host with all path prefixes of
    lengths that rules have.  Urls that no rule fits get ``default``: the list holds nothing on them.

    Null urls and urls without ``://``: empty host and path, no rule.  An empty rule list or table is
    fine.  Null ids and repeated rows stay.  Other columns are not read.
    """
    index = RuleIndex(rules)
    common.known_to_workers(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"))
    shared = pages.sparkSession.sparkContext.broadcast(index)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        digests = own.mapped()
        for batch, urls in common.pieces(batches):
            valid = batch.column(1).is_valid().to_pylist()
            split = [split_url(u.decode() if v else None) for u, v in zip(urls, valid)]
            owner: list[int] = []
            names: list[bytes] = []
            for i, (host, path) in enumerate(split):
                labels = host.split(".") if host else []
                suffixes = [".".join(labels[k:]) for k in range(len(labels))]
                for n in own.path_lengths:
                    if n <= len(path):
                        names.extend(f"{s}{path[:n]}".encode() for s in suffixes)
                        owner.extend([i] * len(suffixes))
            best: dict[int, tuple[tuple[int, int], int]] = {}
            places = own.probe(digests, names)
            for k in np.flatnonzero(places >= 0):
                name = names[k].decode()
                rank = (len(name), len(name.split("/", 1)[0]))
                if owner[k] not in best or rank > best[owner[k]][0]:
                    best[owner[k]] = (rank, int(places[k]))
            found = [best[i][1] if i in best else -1 for i in range(len(split))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([own.name(f).decode() if f >= 0 else None for f in found], pa.string()),
                    pa.array([own.verdicts[f] if f >= 0 else default for f in found], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return rows.mapInArrow(judge, SCHEMA)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM s
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), f AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict, length(rhost) AS hl
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, max_by(rule, length(rule) * 1000 + hl) AS rule,
       coalesce(max_by(verdict, length(rule) * 1000 + hl), 'allow') AS verdict
FROM f GROUP BY page_id, host, path
"""
