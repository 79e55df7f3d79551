"""URL filter: a sorted array of host digests, memory-mapped and probed by binary search."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import map_batches, materialised, send_package
from flowengine.session import work_path

#: Rules in one index file, which one task sorts. A larger list is dealt over several files.
RULES_PER_FILE = 500_000
_TEXT = np.dtype([("host", "<u8"), ("path", "<u8"), ("end", "<u8"), ("allow", "u1")])


def host_and_path(url):
    """The host and path columns of a URL column: the host runs from the first `://` to `/`, `?`,
    `#` or the end, with A-Z lower-cased; the path from there to `?`, `#` or the end. Both are
    empty without `://` or URL."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, url.substr(start + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def build_index(rules: DataFrame, rules_per_file: int = RULES_PER_FILE) -> list[str]:
    """Index files of the rules in the shared work folder; returns their places.

    `rules` has host, path and verdict (`allow` or `block`). They are dealt by a hash of host and
    path into shares of about `rules_per_file`, so that a host with many rules is in many; one
    task sorts each share and writes its file: the sorted digests of the hosts, the places of the
    strings and the strings. A file gets its name when it is whole, and a repeated task writes the
    same again. The driver only sees the files' names. Rules with a null are left out; of rules
    with the same host and path, a block outweighs an allow.
    """
    spark = rules.sparkSession
    kept = materialised(
        rules.dropna(subset=["host", "path", "verdict"])
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict")),
        "url-rules",
    )
    files = max(1, -(-kept.count() // rules_per_file))
    folder = work_path(spark, "url-index")

    def write(share: pa.Table) -> pa.Table:
        number = share.column("share")[0].as_py()
        path = f"{folder}/{number}.bin"
        _write(path, share.select(["host", "path", "verdict"]))
        return pa.table({"path": pa.array([path], pa.string())})

    send_package(spark)
    shares = kept.withColumn("share", F.pmod(F.xxhash64("host", "path"), F.lit(files)))
    # a file for each share, whatever a write costs: names are collected, not rules
    return sorted(r.path for r in shares.groupBy("share").applyInArrow(write, "path string").collect())


def _digests(hosts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(h.encode()) for h in hosts], dtype="<u8")


def _write(path: str, rules: pa.Table) -> None:
    """Count, sorted digests, a record per rule in the same order, strings."""
    hosts, paths, verdicts = (rules.column(c).to_pylist() for c in range(3))
    texts = [t.encode() for pair in zip(hosts, paths, strict=True) for t in pair]
    ends = np.cumsum([len(t) for t in texts], dtype="<u8")
    records = np.zeros(len(hosts), dtype=_TEXT)
    records["path"], records["end"] = ends[0::2], ends[1::2]
    records["host"][1:] = ends[1::2][:-1]
    records["allow"] = [v == "allow" for v in verdicts]
    digests = _digests(hosts)
    order = np.argsort(digests, kind="stable")
    content = b"".join([
        np.uint64(len(hosts)).tobytes(), digests[order].tobytes(), records[order].tobytes(), *texts,
    ])
    files, place = _file_system(path)
    if isinstance(files, fs.LocalFileSystem):
        files.create_dir(os.path.dirname(place), recursive=True)
    aside = f"{os.path.dirname(place)}/.{uuid.uuid4().hex}"
    with files.open_output_stream(aside) as file:
        file.write(content)
    files.move(aside, place)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a place in the shared folder, and the place's name there."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def _mapped(path: str) -> np.ndarray:
    """The bytes of an index file: mapped where the shared folder is mounted, else fetched."""
    files, place = _file_system(path)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(place, dtype="u1", mode="r")
    with files.open_input_file(place) as file:
        return np.frombuffer(file.read(), dtype="u1")


class _Index:
    """One mapped file."""

    def __init__(self, path: str):
        raw = _mapped(path)
        n = int(raw[:8].view("<u8")[0])
        self.digests = raw[8:8 + 8 * n].view("<u8")
        records = 8 + 8 * n
        self.records = raw[records:records + _TEXT.itemsize * n].view(_TEXT)
        self.texts = raw[records + _TEXT.itemsize * n:]

    def rules(self, hosts: list[str]) -> dict[str, list[tuple[str, str]]]:
        """(path, verdict) of each host that has rules, the longest path first. A digest only
        leads to a rule; the stored host decides."""
        keys = _digests(hosts)
        low = np.searchsorted(self.digests, keys, side="left")
        high = np.searchsorted(self.digests, keys, side="right")
        found = {}
        for k in np.flatnonzero(high > low):
            for start, middle, end, allow in self.records[low[k]:high[k]].tolist():
                if bytes(self.texts[start:middle]).decode() == hosts[k]:
                    rule = bytes(self.texts[middle:end]).decode()
                    found.setdefault(hosts[k], []).append((rule, "allow" if allow else "block"))
        return {h: sorted(r, key=lambda x: -len(x[0])) for h, r in found.items()}


def _suffixes(host: str) -> list[str]:
    """The host and its parent domains."""
    return [host, *(host[i + 1:] for i, c in enumerate(host) if c == ".")]


def judge(pages: DataFrame, files: list[str], default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page's URL.

    A rule fits its host and all subdomains if the URL's path starts with the rule's path. The
    longest fitting rule (host and path together) decides, of equally long ones the last in
    code-point order; `rule` is its text. Where none fits, rule is null and the verdict `default`. A null URL, or one without `://`, has an empty host
    and path. Every input row gives one row, repeated rows and null ids too; other columns are
    left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [_Index(path) for path in files]
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            asked = sorted({s for h in set(hosts) for s in _suffixes(h)})
            known: dict[str, list] = {}
            for index in indexes:
                for host, found in index.rules(asked).items():
                    known.setdefault(host, []).extend(found)
            rules, verdicts = [], []
            for host, path in zip(hosts, paths, strict=True):
                best = max(
                    (
                        (len(domain) + len(rule), domain + rule, verdict)
                        for domain in _suffixes(host)
                        for rule, verdict in known.get(domain, ())
                        if path.startswith(rule)
                    ),
                    default=(0, None, default),
                )
                rules.append(best[1])
                verdicts.append(best[2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col("_url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("_url"))
    parsed = rows.select("page_id", host.alias("host"), path.alias("path"))
    schema = "page_id long, host string, path string, rule string, verdict string"
    return map_batches(parsed, run, schema)
