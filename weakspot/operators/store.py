"""A vector table that is written range by range and can be taken up again.

The key space is cut into ranges once, when the store is made. A run writes
each missing range (or a few at a time) to a folder of its own and then publishes it: an entry
naming the range, the folder and its rows appears in the manifest by a rename,
which is atomic. Readers follow the manifest, so they see whole ranges only; a
run that stops leaves at most one folder that no entry names. The next run
goes on with the ranges that have no entry. ``catch_up`` adds rows whose keys
came later, by an anti-join with what is stored.

Ranges are predicates on the key, so a source sorted by key is read only where
the range is. One writer at a time. Rows with a NULL key are never stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Encode = Callable[[DataFrame], DataFrame]


class VectorStore:
    """``encode`` turns rows (key and inputs) into (key, vector)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "row_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _publish(self, name: str, what: dict) -> None:
        """The entry appears whole or not at all."""
        hidden = self._at(f"_tmp-{uuid.uuid4().hex}")
        out = self._fs.create(hidden, False)
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        self._fs.mkdirs(self._at(name).getParent())
        if self._fs.exists(self._at(name)) or not self._fs.rename(hidden, self._at(name)):
            self._fs.delete(hidden, False)
            raise RuntimeError(f"{name} was published by another writer")

    def _entry(self, name: str) -> dict:
        # a manifest entry is a line of JSON
        return json.loads(self.spark.read.text(f"{self.path}/{name}").first()[0])

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(folder)))

    def ranges(self, rows: DataFrame, parts: int) -> list[tuple]:
        """The stored ranges (low, high), open at both ends; made at the first call."""
        if not self._fs.exists(self._at("ranges.json")):
            kind = rows.schema[self.key].dataType
            if isinstance(kind, T.NumericType):
                edges = rows.approxQuantile(self.key, [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
                edges = [int(e) if isinstance(kind, T.IntegralType) else e for e in edges]
            else:  # evenly spread hexadecimal prefixes suit hashed text keys
                edges = [f"{i * 65536 // parts:04x}" for i in range(1, parts)]
            cuts = [None, *sorted(set(edges)), None]
            self._publish("ranges.json", {"ranges": list(zip(cuts, cuts[1:]))})
        return [tuple(r) for r in self._entry("ranges.json")["ranges"]]

    def within(self, low, high) -> Column:
        inside = F.col(self.key).isNotNull()
        if low is not None:
            inside &= F.col(self.key) >= low
        return inside if high is None else inside & (F.col(self.key) < high)

    def finished(self) -> dict[str, dict]:
        """Published entries by name."""
        return {n: self._entry(f"manifest/{n}") for n in self._names("manifest")}

    def _write(self, name: str, made: DataFrame, what: dict) -> int:
        folder = f"data/{uuid.uuid4().hex}"
        made.write.parquet(f"{self.path}/{folder}")
        rows = self.spark.read.parquet(f"{self.path}/{folder}").count()
        self._publish(f"manifest/{name}", {**what, "folder": folder, "rows": rows})
        return rows

    def _write_together(self, wave: dict[int, tuple], rows: DataFrame, encode: Encode) -> None:
        """Several ranges in one job, each to a folder of its own."""
        folder = f"data/{uuid.uuid4().hex}"
        wanted, number = F.lit(False), F.lit(None).cast("int")
        for i, (low, high) in wave.items():
            wanted |= self.within(low, high)
            number = F.when(self.within(low, high), i).otherwise(number)
        made = encode(rows.filter(wanted)).withColumn("__range", number)
        made.write.partitionBy("__range").parquet(f"{self.path}/{folder}")
        stored = self.spark.read.schema(made.schema).parquet(f"{self.path}/{folder}")
        counts = {r["__range"]: r["count"] for r in stored.groupBy("__range").count().collect()}
        for i, (low, high) in wave.items():
            self._publish(f"manifest/range-{i:05d}",
                          {"low": low, "high": high, "folder": f"{folder}/__range={i}", "rows": counts.get(i, 0)})

    def write(self, rows: DataFrame, encode: Encode, parts: int = 16, most: int | None = None, together: int = 1) -> int:
        """Encode and publish the ranges that are missing, at most ``most`` of
        them; returns how many are left.

        ``together`` ranges are encoded in one job, which saves passes over
        whatever ``encode`` joins with; a run that stops loses as many.
        """
        ranges = self.ranges(rows, parts)
        done = self.finished()
        missing = [i for i in range(len(ranges)) if f"range-{i:05d}" not in done]
        todo = missing[:most]
        for start in range(0, len(todo), together):
            wave = {i: ranges[i] for i in todo[start:start + together]}
            if together > 1:
                self._write_together(wave, rows, encode)
                continue
            for i, (low, high) in wave.items():
                self._write(f"range-{i:05d}", encode(rows.filter(self.within(low, high))), {"low": low, "high": high})
        return len(missing) - len(todo)

    def catch_up(self, rows: DataFrame, encode: Encode) -> int:
        """Encode and publish rows of finished ranges whose keys are not stored."""
        stored = self.read()
        if stored is None:
            return 0
        known = F.lit(False)
        for entry in self.finished().values():
            if "low" in entry:
                known |= self.within(entry["low"], entry["high"])
        late = rows.filter(known).join(stored.select(self.key), self.key, "left_anti")
        if late.isEmpty():
            return 0
        return self._write(f"late-{uuid.uuid4().hex}", encode(late), {})

    def read(self) -> DataFrame | None:
        """All published vectors; None before the first entry."""
        folders = [f"{self.path}/{e['folder']}" for e in self.finished().values() if e["rows"]]
        return self.spark.read.parquet(*folders) if folders else None

    def vacuum(self) -> int:
        """Delete folders that no entry names; returns how many."""
        named = {e["folder"].split("/")[1] for e in self.finished().values()}
        orphans = [n for n in self._names("data") if n not in named]
        for n in orphans:
            self._fs.delete(self._at(f"data/{n}"), True)
        return len(orphans)
