"""The stored tables of a corpus, as partitioned Parquet below one folder.

documents, authors and documents_x_authors are appended to, one `load_id`
folder per load, and sorted by id inside folders of a million ids. Postings are
bucketed by document and lie in folders by load and by the size of the document,
sorted by gram: hits are then counted where the postings are read, and the folders
of small documents can be left out when they cannot reach a result. A corpus has
one writer at a time.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom import schemas
from corpusloom.functions.text import preview, shown_title
from corpusloom.operators.keys import FEW_KEYS_PART, KEY_PARTS, id_block, key_part
from corpusloom.operators.lookup import stored_already
from corpusloom.session import empty_frame

# Loads whose names are listed in a plan.
_FEW_LOADS = 500

# Keys of a load that go to one folder; more are spread over folders by their hash.
_FEW_KEYS = 32_768

#: The tables that a load adds to.
_ENTITIES = {
    "documents": schemas.DOCUMENTS,
    "results": schemas.RESULTS,
    "authors": schemas.AUTHORS,
    "documents_x_authors": schemas.RELATIONS,
    "document_keys": schemas.DOCUMENT_KEYS,
    "author_keys": schemas.AUTHOR_KEYS,
}


@dataclass(frozen=True)
class Index:
    """An index as searches read it: whole loads only.

    postings: bucketed by doc_id into `buckets`; bounds: what a gram adds to a
    document of a tier at most.
    """

    postings: DataFrame
    bounds: DataFrame
    buckets: int


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    root: str

    #: Loads of this name count documents again that another load owns.
    AGAIN = "again-"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, schema: StructType) -> DataFrame:
        """A stored table, or an empty frame when nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, schema)

    def whole(self, name: str, schema: StructType) -> DataFrame:
        """The rows of a stored table whose load is complete. Loads are looked up before
        the files are listed, so of a load that ends in between nothing is seen."""
        done = self.loads().select("load_id")
        some = [r["load_id"] for r in done.limit(_FEW_LOADS + 1).collect()]
        few = set(some) if len(some) <= _FEW_LOADS else None
        return self._of_loads(self.read(name, schema), few, done).select(schema.names)

    def _of_loads(self, rows: DataFrame, few: set[str] | None, loads: DataFrame) -> DataFrame:
        """Few loads choose their folders as literals; many are joined."""
        if few is not None:
            return rows.where(F.col("load_id").isin(sorted(few)))
        return rows.join(F.broadcast(loads.distinct()), "load_id", "left_semi")

    def documents(self) -> DataFrame:
        return self.whole("documents", schemas.DOCUMENTS)

    def results(self) -> DataFrame:
        """What search results show: (id, title, preview) of every document."""
        return self.whole("results", schemas.RESULTS)

    def authors(self) -> DataFrame:
        return self.whole("authors", schemas.AUTHORS)

    def relations(self) -> DataFrame:
        return self.whole("documents_x_authors", schemas.RELATIONS)

    def known_ids(self, name: str, schema: StructType, batch: DataFrame) -> DataFrame:
        """(keys..., id) of the keys in `batch` that a key table has stored. Only the
        folders of their hashes are read, at most `KEY_PARTS` numbers, and those of
        loads of few keys."""
        keys = [f.name for f in schema.fields if f.name not in ("id", "load_id", "key_part")]
        parts = sorted(r[0] for r in batch.select(key_part(keys)).distinct().collect())
        stored = self.whole(name, schema)
        if len(parts) < KEY_PARTS:
            stored = stored.where(F.col("key_part").isin(parts) | (F.col("key_part") == FEW_KEYS_PART))
        return stored_already(stored.drop("load_id", "key_part"), batch, keys)

    def last_ids(self) -> tuple[int, int]:
        """The highest ids of documents and authors; one row per load tells them."""
        last = [F.coalesce(F.max(f"last_{x}_id"), F.lit(0)) for x in ("document", "author")]
        return tuple(self.loads().agg(*last).first())

    def stored_by(self, load_id: str) -> dict[str, DataFrame]:
        """What a load has stored so far, complete or not."""
        mine = F.col("load_id") == load_id
        names = {"documents": schemas.DOCUMENTS, "authors": schemas.AUTHORS, "documents_x_authors": schemas.RELATIONS}
        return {name: self.read(name, schema).where(mine) for name, schema in names.items()}

    def begin(self, load_id: str) -> None:
        """Open a load. What loads before it have left unfinished, its own earlier
        attempt too, is taken back, so it is found by this or a later load anew."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
            raise ValueError(f"a load or run is named by letters, digits, '.', '_' and '-', not {load_id!r}")
        begun = self.read("begun", schemas.BEGUN).distinct()
        for row in begun.join(self.loads(), "load_id", "left_anti").collect():
            for name, schema in _ENTITIES.items():
                self._empty(f"{name}/load_id={row.load_id}", schema, schema.names[-1])
        self.spark.range(1).select(F.lit(load_id).alias("load_id")).write.mode("append").parquet(self.path("begun"))

    def _empty(self, folder: str, schema: StructType, part: str) -> None:
        """Leave no files in one folder of a table that is partitioned further by `part`."""
        columns = [f for f in schema.fields if f.name not in ("load_id", "run_id")]
        none = empty_frame(self.spark, StructType(columns))
        none.write.mode("overwrite").partitionBy(part).parquet(self.path(folder))

    def generation(self) -> tuple[int, int]:
        """The number of the index that readers use, and its buckets; zeros before the first."""
        rows = self.read("postings_generations", schemas.GENERATIONS)
        last = rows.agg(F.max(F.struct("generation", "buckets")).alias("last")).first()["last"]
        return (last["generation"], last["buckets"]) if last else (0, 0)

    def index(self) -> Index | None:
        """The index in use, or None before the first."""
        number, buckets = self.generation()
        if not buckets:
            return None
        # A load that was cut off has no row here.
        rows = self.read(_part("indexed", number), schemas.INDEXED)
        some = rows.select("load_id", "replaces").limit(_FEW_LOADS + 1).collect()
        few = None
        if len(some) <= _FEW_LOADS:
            few = {r["load_id"] for r in some} - {name for r in some for name in r["replaces"]}
        whole = self.indexed(number).select("load_id")
        postings = self._of_loads(self.spark.table(self._bucketed(number, buckets)), few, whole)
        bounds = self._of_loads(self.read(_part("bounds", number), schemas.BOUNDS), few, whole)
        return Index(postings.select(schemas.POSTINGS.names), bounds, buckets)

    def postings(self) -> DataFrame:
        index = self.index()
        return index.postings if index else empty_frame(self.spark, schemas.POSTINGS)

    def indexed(self, number: int | None = None) -> DataFrame:
        """One row of measurements per load that the index holds, more if it was indexed again."""
        number = self.generation()[0] if number is None else number
        rows = self.read(_part("indexed", number), schemas.INDEXED)
        replaced = rows.select(F.explode("replaces").alias("load_id")).distinct()
        return rows.join(F.broadcast(replaced), "load_id", "left_anti").select(schemas.INDEXED.names)

    def is_merged(self, load_id: str) -> bool:
        """Whether a merged load of the index in use holds this one."""
        rows = self.read(_part("indexed", self.generation()[0]), schemas.INDEXED)
        return not rows.where(F.array_contains("replaces", load_id)).isEmpty()

    def merge_indexed(self, loads: list[str], merged: str, started: float) -> None:
        """Put the postings of `loads` into one load, and free theirs."""
        number, _ = self.generation()
        of = F.col("load_id").isin(loads)
        counted = self.indexed(number).where(of).groupBy("load_id").agg(
            F.max("docs_indexed").alias("docs_indexed"), F.max("grams_generated").alias("grams_generated")
        )
        sums = counted.agg(F.sum("docs_indexed").alias("docs_indexed"), F.sum("grams_generated").alias("grams_generated"))
        one = sums.select(F.lit(merged).alias("load_id"), "*")
        self.index_load(self.index().postings.where(of), merged, one, started, loads)
        for load_id in loads:
            for table, schema in (("postings", schemas.POSTINGS), ("bounds", schemas.BOUNDS)):
                self._empty(f"{_part(table, number)}/load_id={load_id}", schema, "tier")

    def searches(self) -> DataFrame:
        return self.read("searches", schemas.SEARCHES)

    def runs(self, stream: str) -> int:
        """How many runs of a stream have ended."""
        return self.read("ended_runs", schemas.ENDED_RUNS).where(F.col("stream") == stream).distinct().count()

    def end_run(self, stream: str, number: int) -> None:
        row = self.spark.range(1).select(
            F.lit(stream).alias("stream"), F.lit(number).cast("long").alias("number")
        )
        row.write.mode("append").parquet(self.path("ended_runs"))

    def free_claims(self, run_id: str) -> None:
        """Leave no claims of an ended run; those of other runs stay."""
        self._empty(f"claimed_dois/run_id={run_id}", schemas.CLAIMED_DOIS, "batch")

    def claimed_dois(self) -> DataFrame:
        return self.read("claimed_dois", schemas.CLAIMED_DOIS)

    def loads(self) -> DataFrame:
        return self.read("loads", schemas.LOADS)

    def append_keys(self, rows: DataFrame, name: str, schema: StructType, load_id: str) -> None:
        """Add (keys..., id) of one load, sorted by key, with Bloom filters on the first key.
        A small load is one file: a stream of them would leave `KEY_PARTS` files each, which
        every later load had to list."""
        keys = [f.name for f in schema.fields if f.name not in ("id", "load_id", "key_part")]
        few = rows.select("id").limit(_FEW_KEYS + 1).count() <= _FEW_KEYS
        part = F.lit(FEW_KEYS_PART) if few else key_part(keys)
        # Else one file per folder, however few its rows: making them is shared by the tasks.
        tasks = 1 if few else min(KEY_PARTS, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        (
            rows.select(*keys, "id", F.lit(load_id).alias("load_id"), part.alias("key_part"))
            .repartition(tasks, "key_part")
            .sortWithinPartitions("key_part", *keys)
            .write.mode("append")
            .option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
            .partitionBy("load_id", "key_part")
            .parquet(self.path(name))
        )

    def append_entities(self, rows: DataFrame, name: str, id_col: str, load_id: str) -> None:
        """Add the rows of one load, in files of even size sorted by id.

        `rebalance` lets adaptive execution split a large block over tasks and
        merge small ones.
        """
        (
            rows.withColumn("load_id", F.lit(load_id))
            .withColumn("id_block", id_block(id_col))
            .hint("rebalance", "id_block")
            .sortWithinPartitions("id_block", id_col)
            .write.mode("append")
            .partitionBy("load_id", "id_block")
            .parquet(self.path(name))
        )

    def _bucketed(self, number: int, buckets: int) -> str:
        """The session's name of a stored generation, whose files say which bucket they
        hold; only a table of a catalog tells Spark so."""
        path = self.path(_part("postings", number))
        name = f"postings_{hashlib.md5(path.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            listed = "spark.sql.hive.manageFilesourcePartitions"
            before = self.spark.conf.get(listed)
            # Partitions are found in the folders, not registered one by one.
            self.spark.conf.set(listed, "false")
            try:
                columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POSTINGS.fields)
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                    f"PARTITIONED BY (load_id, tier) CLUSTERED BY (doc_id) SORTED BY (gram, doc_id) "
                    f"INTO {buckets} BUCKETS LOCATION '{path}'"
                )
            finally:
                self.spark.conf.set(listed, before)
        self.spark.catalog.refreshTable(name)
        return name

    def open_index(self, buckets: int) -> int:
        """Begin an empty index if there is none; the number of buckets of the one in use."""
        number, used = self.generation()
        if not used:
            self._write_generation(number + 1, buckets)
        return used or buckets

    def _write_generation(self, number: int, buckets: int) -> None:
        row = self.spark.range(1).select(
            F.lit(number).cast("long").alias("generation"), F.lit(buckets).cast("int").alias("buckets")
        )
        row.write.mode("append").parquet(self.path("postings_generations"))

    def index_all(self, postings: DataFrame, loads: DataFrame, buckets: int, started: float) -> None:
        """A new index from postings (gram, doc_id, tf, load_id, tier) spread by bucket,
        and one row (load_id, docs_indexed, grams_generated) per load.

        It is written beside the one in use, and a last small row makes it the
        current one, so a build that is cut off leaves the old answers. The index
        before the old one is freed.
        """
        now, _ = self.generation()
        to = now + 1
        name = self._bucketed(to, buckets)
        postings.select(schemas.POSTINGS.names).write.insertInto(name, overwrite=True)
        bounds = self._write_bounds(self.spark.table(name), to, "static")
        self._write_indexed(bounds, loads, to, "overwrite", started)
        self._write_generation(to, buckets)
        for table in ("postings", "bounds", "indexed") if now > 1 else ():
            old = empty_frame(self.spark, schemas.INDEXED)
            old.write.mode("overwrite").parquet(self.path(_part(table, now - 1)))

    def index_load(
        self, postings: DataFrame, load_id: str, loads: DataFrame, started: float, replaces: list[str] | None = None
    ) -> None:
        """Put the postings of one load (one row in `loads`) into the index in use, or in the
        place of those it has there, so that indexing a load again does not count it twice.
        Loads that it `replaces` are no longer read."""
        number, buckets = self.generation()
        name = self._bucketed(number, buckets)
        view = f"load_{uuid.uuid4().hex}"
        postings.select("gram", "doc_id", "tf", "tier").createOrReplaceTempView(view)
        quoted = load_id.replace("\\", "\\\\").replace("'", "\\'")
        # A merged load is new, and reads the table that it is added to.
        insert = "INTO" if replaces else "OVERWRITE"
        self.spark.sql(f"INSERT {insert} TABLE {name} PARTITION (load_id = '{quoted}', tier) SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)
        own = self.spark.table(name).where(F.col("load_id") == load_id)
        bounds = self._write_bounds(own, number, "dynamic").where(F.col("load_id") == load_id)
        self._write_indexed(bounds, loads, number, "append", started, replaces)

    def _write_bounds(self, postings: DataFrame, number: int, mode: str) -> DataFrame:
        path = self.path(_part("bounds", number))
        (
            postings.groupBy("load_id", "tier", "gram")
            .agg(F.max("tf").alias("most"), F.count("*").alias("docs"), F.sum("tf").alias("occurrences"))
            .select(schemas.BOUNDS.names)
            .hint("rebalance", "load_id", "tier")
            .sortWithinPartitions("load_id", "tier", "gram")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy("load_id", "tier")
            .parquet(path)
        )
        return self.read(_part("bounds", number), schemas.BOUNDS)

    def _write_indexed(
        self,
        bounds: DataFrame,
        loads: DataFrame,
        number: int,
        mode: str,
        started: float,
        replaces: list[str] | None = None,
    ) -> None:
        """The rows that make loads visible, with what was counted while indexing."""
        run = uuid.uuid4().hex
        sums = bounds.groupBy("load_id").agg(F.sum("occurrences").alias("n"), F.sum("docs").alias("postings"))
        none = F.lit(0).cast("long")
        rows = loads.join(sums, "load_id", "left").select(
            "load_id",
            "docs_indexed",
            "grams_generated",
            F.coalesce("n", none).alias("grams_inserted"),
            F.coalesce("postings", none).alias("postings"),
            F.lit(time.monotonic() - started).alias("seconds"),
            F.lit(run).alias("run"),
            F.array(*[F.lit(x) for x in replaces or []]).cast("array<string>").alias("replaces"),
        )
        rows.write.mode(mode).parquet(self.path(_part("indexed", number)))

    def write_search(self, row: DataFrame) -> None:
        row.select(schemas.SEARCHES.names).write.mode("append").parquet(self.path("searches"))

    def write_results(self, load_id: str) -> None:
        """Titles and previews of a load's stored documents, in small row groups with a
        filter on the id: a search result reads a few of them instead of whole texts.
        Written as a whole for the load, so repeating it changes nothing."""
        (
            self.stored_by(load_id)["documents"].select(
                "id", shown_title("title").alias("title"), preview("abstract").alias("preview"), "load_id", "id_block"
            )
            .hint("rebalance", "id_block")
            .sortWithinPartitions("id_block", "id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("parquet.block.size", 1 << 20)
            .option("parquet.bloom.filter.enabled#id", "true")
            .partitionBy("load_id", "id_block")
            .parquet(self.path("results"))
        )

    def write_load(self, row: DataFrame) -> None:
        """The row that completes a load."""
        (
            row.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "load_id")
            .parquet(self.path("loads"))
        )

    def claim_dois(self, dois: DataFrame, run_id: str, batch: int) -> None:
        (
            dois.select("doi")
            .withColumn("run_id", F.lit(run_id))
            .withColumn("batch", F.lit(batch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "batch")
            .parquet(self.path("claimed_dois"))
        )

    def counts(self) -> DataFrame:
        """(table_name, rows) of the four stored tables."""
        frames = {
            "documents": self.documents(),
            "authors": self.authors(),
            "documents_x_authors": self.relations(),
            "ngrams": self.postings(),
        }
        return row_counts(frames)


def _part(table: str, generation: int) -> str:
    return f"{table}/{generation:06d}"


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) per frame; a frame with `tf` counts its occurrences,
    the rows an index without aggregated postings would hold."""
    counted = None
    for name, frame in frames.items():
        n = F.coalesce(F.sum("tf"), F.lit(0)) if "tf" in frame.columns else F.count(F.lit(1))
        row = frame.agg(n.cast("bigint").alias("rows"))
        row = row.select(F.lit(name).alias("table_name"), "rows")
        counted = row if counted is None else counted.unionByName(row)
    return counted


def sample_titles(documents: DataFrame, n: int = 5) -> DataFrame:
    """Titles of the first `n` documents by id."""
    return documents.select("id", "title").orderBy("id").limit(n)
