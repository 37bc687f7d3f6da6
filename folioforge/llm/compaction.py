"""A store of immutable Parquet shards with size-tiered compaction.

Arrivals are appended as small shards.  Compaction looks at the sizes: shards of
one tier (sizes within a factor of ``FANOUT``) are merged, as soon as ``FANOUT`` of
them have gathered, into files of about the target size.  Files of half the target
or more aren't rewritten any more.

What a version adds and removes is in its manifest, ``manifests/v<number>.json``;
every ``FULL_EVERY``-th lists all shards, so that a commit is as small as its change
and a version is read from a few files.  A version becomes current by one atomic
rename that fails if another writer has made it before, so readers see the old
version or the new one, whole.  A writer that comes second commits its files on top
of the other's version; a merge whose shards another has merged meanwhile is
dropped.
"""

from __future__ import annotations

import json
import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20
FANOUT = 4
#: Shards below this are all of the lowest tier.
SMALLEST_BYTES = 1 << 20
#: Merged files written by one job.
WAVE = 64
#: Versions from one full list of shards to the next.
FULL_EVERY = 16
#: Times that a writer commits anew on top of another's version.
TRIES = 20


class VersionTaken(RuntimeError):
    """Another writer has committed this version."""


class ShardStore:
    """The store at ``path``, a folder that driver and executors reach by
    Hadoop's file-system interface."""

    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, smallest_bytes: int = SMALLEST_BYTES):
        self.spark, self.path, self.target, self.fanout, self.smallest = spark, path.rstrip("/"), target_bytes, fanout, smallest_bytes
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def _list(self, folder: str) -> list[tuple[str, int]]:
        p, fs = self._at(folder)
        return sorted((x.getPath().toString(), x.getLen()) for x in fs.listStatus(p)) if fs.exists(p) else []

    def _read_json(self, path: str) -> dict:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def versions(self) -> list[int]:
        """All committed versions."""
        names = [p.rsplit("/", 1)[1] for p, _ in self._list(f"{self.path}/manifests")]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, the newest by default, with all its shards;
        version 0 is empty."""
        if version is None:
            version = (self.versions() or [0])[-1]
        if version == 0:
            return {"version": 0, "schema": None, "shards": []}
        there = set(self.versions())
        chain = [self._read_json(f"{self.path}/manifests/v{version:010d}.json")]
        while "shards" not in chain[-1]:
            if chain[-1]["parent"] not in there:  # vacuumed, and so the oldest has a full list beside it
                chain[-1]["shards"] = self._read_json(f"{self.path}/manifests/full-v{chain[-1]['version']:010d}.json")
            else:
                chain.append(self._read_json(f"{self.path}/manifests/v{chain[-1]['parent']:010d}.json"))
        shards = {s["path"]: s for s in chain[-1]["shards"]}
        for m in reversed(chain[:-1]):
            for path in m["removed"]:
                del shards[path]
            shards |= {s["path"]: s for s in m["added"]}
        return chain[0] | {"shards": [shards[p] for p in sorted(shards)]}

    def _draft(self, what: dict | list):
        draft, fs = self._at(f"{self.path}/manifests/.draft-{uuid.uuid4().hex}")
        fs.mkdirs(draft.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        return draft, fs

    def _commit(self, old: dict, added: list[dict], removed: list[str], schema: str, what: str) -> dict:
        new = {"version": old["version"] + 1, "parent": old["version"], "operation": what, "schema": schema, "added": added, "removed": sorted(removed)}
        gone = set(removed)
        shards = sorted([s for s in old["shards"] if s["path"] not in gone] + added, key=lambda s: s["path"])
        if new["version"] % FULL_EVERY == 1:
            new["shards"] = shards
        folder = f"{self.path}/manifests"
        draft, fs = self._draft(new)
        final, _ = self._at(f"{folder}/v{new['version']:010d}.json")
        kind = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(kind, 0)  # no OVERWRITE: it fails if the version is there
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, options)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise VersionTaken(f"version {new['version']} of {self.path} was committed by another writer") from e
            raise
        return new | {"shards": shards}

    def _write(self, df: DataFrame) -> list[dict]:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        files = {p.split("/data/", 1)[1]: n for p, n in self._list(folder) if p.endswith(".parquet")}
        counted = self.spark.read.schema(df.schema).parquet(folder).select(F.input_file_name().alias("file")).groupBy("file").count()  # no column: footers only
        rows = {r["file"].split("/data/", 1)[1]: r["count"] for r in counted.collect()}
        return [{"path": p, "bytes": n, "rows": rows.get(p, 0)} for p, n in files.items()]

    def _delete(self, paths: list[str]) -> None:
        for p in paths:
            q, fs = self._at(f"{self.path}/data/{p}")
            fs.delete(q, False)

    def append(self, df: DataFrame) -> dict:
        """Add the rows as small shards, one for each task that has any.  The
        columns must be those of the store, in any order."""
        added = None
        for _ in range(TRIES):
            old = self.manifest()
            if old["schema"] is not None:
                df = df.select(*(f"`{c}`" for c in self._schema(old).names))
                if df.schema.simpleString() != self._schema(old).simpleString():
                    self._delete([s["path"] for s in added or []])
                    raise ValueError(f"the store has {self._schema(old).simpleString()}")
            if added is None:
                added = [s for s in self._write(df) if s["rows"]]
            try:
                return self._commit(old, added, [], old["schema"] or df.schema.json(), "append")
            except VersionTaken:
                continue  # the files stay; they are added to the other writer's version
        raise VersionTaken(f"{TRIES} other writers came before")

    @staticmethod
    def _schema(manifest: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(manifest["schema"]))

    def tier(self, size: int) -> int:
        """Sizes of one tier differ by less than the fanout."""
        return 0 if size < self.smallest else 1 + int(math.log(size / self.smallest, self.fanout))

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """Groups of shards to merge, each into one file: in tiers that hold
        ``fanout`` shards or more, small ones first, up to the target size."""
        by_tier: dict[int, list[dict]] = {}
        for s in shards:
            if s["bytes"] < self.target / 2:
                by_tier.setdefault(self.tier(s["bytes"]), []).append(s)
        groups = []
        for _, members in sorted(by_tier.items()):
            if len(members) < self.fanout:
                continue
            group: list[dict] = []
            for s in sorted(members, key=lambda s: (s["bytes"], s["path"])):
                if group and sum(x["bytes"] for x in group) + s["bytes"] > self.target:
                    groups.append(group)
                    group = []
                group.append(s)
            groups.append(group)
        return [g for g in groups if len(g) > 1]

    def compact(self) -> dict:
        """Merge until no tier is full; each round is a version of its own.

        A file is made by one task that reads its shards in turn: rows aren't
        shuffled, and no more than the target size is read by a task.
        """
        while groups := self.plan((old := self.manifest())["shards"]):
            schema, made = self._schema(old), []
            for i in range(0, len(groups), WAVE):
                parts = [self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{s['path']}" for s in g)).coalesce(1) for g in groups[i : i + WAVE]]
                made += self._write(reduce(DataFrame.union, parts))
            merged = {s["path"] for g in groups for s in g}
            if sum(s["rows"] for s in made) != sum(s["rows"] for g in groups for s in g):
                raise RuntimeError("the merged files have other rows than the shards")
            for _ in range(TRIES):
                try:
                    self._commit(old, made, list(merged), old["schema"], "compact")
                    break
                except VersionTaken:
                    old = self.manifest()
                    if not merged <= {s["path"] for s in old["shards"]}:  # another writer has merged some
                        self._delete([s["path"] for s in made])
                        break
        return old

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError("the store is empty")
        schema = self._schema(m)
        if not m["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{s['path']}" for s in m["shards"]))

    def vacuum(self, keep: int = 1) -> int:
        """Delete the manifests before the last ``keep`` and the files that none of
        those has; readers of older versions must have ended, and no append
        may be under way.  Returns the number of files deleted."""
        versions = self.versions()
        stay = {s["path"] for v in versions[-keep:] for s in self.manifest(v)["shards"]}
        oldest = versions[-keep] if len(versions) >= keep else 0
        if oldest and oldest % FULL_EVERY != 1 and len(versions) > keep:  # its list, as those that it builds on go
            draft, fs = self._draft(self.manifest(oldest)["shards"])
            full, _ = self._at(f"{self.path}/manifests/full-v{oldest:010d}.json")
            if not fs.rename(draft, full) and not fs.exists(full):
                raise RuntimeError(f"{full} can't be written")
        for v in versions[:-keep]:
            p, fs = self._at(f"{self.path}/manifests/v{v:010d}.json")
            fs.delete(p, False)
        gone = 0
        for folder, _ in self._list(f"{self.path}/data"):
            files = [p for p, _ in self._list(folder) if p.endswith(".parquet")]
            dead = [p for p in files if p.split("/data/", 1)[1] not in stay]
            gone += len(dead)
            for p in [folder] if len(dead) == len(files) else dead:
                q, fs = self._at(p)
                fs.delete(q, True)
        return gone


def sharded(spark: SparkSession, df: DataFrame, path: str, **options) -> DataFrame:
    """Append ``df`` to the store at ``path``, compact it, delete what no version
    needs, and return the store's rows.

    All columns and rows are kept as they are, whatever the columns' names: NULLs,
    empty and very long texts, ties and repeated rows.  An empty table gives a store
    of a schema without shards.
    """
    store = ShardStore(spark, path, **options)
    store.append(df)
    store.compact()
    store.vacuum()
    return store.read()


#: Arrivals that :func:`arrivals` makes of a table.
ARRIVALS = 4


def arrivals(spark: SparkSession, docs: DataFrame, path: str, **options) -> DataFrame:
    """All of ``docs`` in ``ARRIVALS`` appends, with a compaction after each, and what
    came of it.

    A row of kind ``document`` for each row of the last version (doc_id, lang,
    source, n_chars, text_md5), and one of kind ``arrival`` for each append: its
    number, the rows that its version has when it is read again at the end, and
    whether the store kept its rules: versions follow each other without a gap, the
    manifest counts the rows that are read, no merged file is above one and a half
    times the target, and no tier is full once it is compacted.
    """
    store = ShardStore(spark, path, **options)
    of = F.coalesce(F.pmod("doc_id", F.lit(ARRIVALS)), F.lit(0))
    seen = []
    for i in range(ARRIVALS):
        before = store.manifest()["version"]
        version = store.append(docs.where(of == i))["version"]
        last = store.compact()
        sizes: dict[int, int] = {}
        for s in last["shards"]:
            if s["bytes"] < store.target / 2:
                sizes[store.tier(s["bytes"])] = sizes.get(store.tier(s["bytes"]), 0) + 1
        full = any(n >= store.fanout for n in sizes.values()) and bool(store.plan(last["shards"]))
        seen.append((i, version, version == before + 1 and last["version"] >= version and not full))
    every = []
    for i, version, ok in seen:
        m = store.manifest(version)
        rows = store.read(version).count() if m["shards"] else 0
        later = store.manifest(version + 1)["added"] if version < store.versions()[-1] else []
        merged = version < store.versions()[-1] and store.manifest(version + 1)["operation"] == "compact"
        small = not merged or all(s["bytes"] <= 1.5 * store.target for s in later)
        every.append(("arrival", i, rows, ok and small and rows == sum(s["rows"] for s in m["shards"])))
    store.vacuum()
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = ("doc_id", "lang", "source", "n_chars")
    out = store.read().select(F.lit("document").alias("kind"), *names, F.md5("text").alias("text_md5"), *(F.lit(None).cast(t).alias(c) for c, t in (("number", "int"), ("rows", "long"), ("ok", "boolean"))))
    notes = spark.createDataFrame(every, "kind string, number int, rows long, ok boolean")
    notes = notes.select("kind", *(F.lit(None).cast(kinds[c]).alias(c) for c in names), F.lit(None).cast("string").alias("text_md5"), "number", "rows", "ok")
    return out.unionByName(notes)


SQL = f"""SELECT 'document' AS kind, doc_id, lang, source, n_chars, md5(text) AS text_md5, CAST(NULL AS INT) AS number, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS BOOLEAN) AS ok FROM documents
UNION ALL SELECT 'arrival', NULL, NULL, NULL, NULL, NULL, CAST(i AS INT), (SELECT count(*) FROM documents WHERE coalesce(doc_id % {ARRIVALS}, 0) <= i), true FROM range({ARRIVALS}) t(i)"""
