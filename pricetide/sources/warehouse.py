"""The four warehouse tables on plain Parquet, with all-or-nothing loads.

Every load writes new folders only and then appends one commit record. Readers follow
the commit records, so a load that fails half way, or is repeated, leaves nothing
visible behind. One writer at a time.

    products/load=<load>/                  products of that load; the newest row of a key counts
    merchants/load=<load>/                 new merchants of that load
    price_history/load=<load>/observed_year=/observed_month=/
    rejects/load=<load>/                   rows the load could not take, with the reason
    commits/                               one small JSON record per load
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import LoadRejected
from ..operators.dimensions import dim_merchants, dim_products, new_merchants
from ..operators.facts import dated, distinct_keys, loadable, new_facts, prepare_facts, star
from ..operators.quality import require_loadable
from ..schema import MERCHANTS, PRICE_HISTORY, PRODUCTS
from ..session import COMPACT, ROWS_PER_FILE, folder_exists

COMMITS = T.StructType(
    [
        T.StructField("load", T.LongType()),
        T.StructField("next_merchant_id", T.IntegerType()),
        T.StructField("next_price_id", T.LongType()),
        T.StructField("received", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("batch", T.StringType()),
        T.StructField("products_base", T.LongType()),
    ]
)

# Range partitioning on these splits a busy month, product or instant between files.
LAYOUT = [
    "observed_year",
    "observed_month",
    "product_id",
    "observed_at",
    "merchant_id",
    "price",
]
FROM_TIME = {"observed_year": "year(observed_at)", "observed_month": "month(observed_at)"}


class LoadResult(NamedTuple):
    load: int
    received: int
    inserted: int
    skipped: int
    rejected: int


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ---

    def _path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def commits(self) -> DataFrame:
        if not folder_exists(self.spark, self._path("commits")):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).json(self._path("commits"))

    def _committed(self) -> list:
        """Commit records in order: one small row per load ever made."""
        return self.commits().orderBy("load").collect()

    def has(self, batch: str) -> bool:
        """Whether a load of this batch was committed."""
        return not self.commits().where(F.col("batch") == batch).isEmpty()

    def _read(self, table: str, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            # No rows, and known to be none: joins need not be planned for a table of unknown size.
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
            return self.spark.range(0).select(*empty)
        reader = self.spark.read.schema(schema).option("basePath", self._path(table))
        return reader.parquet(*folders).select(*schema.names)

    def products(self, done: list | None = None) -> DataFrame:
        """The newest row of each product, since it was first seen.

        A load appends its products, whether they were stored before or not, so that it
        writes and reads no more than itself. Readers take the newest; ``compact_products``
        keeps what they read from growing with the number of loads.
        """
        done = self._committed() if done is None else done
        base = max((c.products_base or 0 for c in done), default=0)
        folders = [self._path("products", f"load={c.load}") for c in done if c.load >= base]
        with_load = T.StructType([*PRODUCTS.fields, T.StructField("load", T.LongType())])
        rows = self._read("products", with_load, folders)
        if len(folders) < 2:
            return rows.drop("load")
        names = [f.name for f in PRODUCTS.fields]
        latest = [n for n in names if n not in ("product_id", "created_at")]
        newest = rows.groupBy("product_id").agg(
            F.max_by(F.struct(*latest), "load").alias("last"), F.min("created_at").alias("created_at")
        )
        return newest.select(
            *[n if n in ("product_id", "created_at") else F.col(f"last.{n}").alias(n) for n in names]
        )

    def compact_products(self) -> int:
        """Write the newest row of every product as one table that later reads start from."""
        done = self._committed()
        if not done:
            return 0
        load = done[-1].load + 1
        self._write(self.products(done), "products", f"load={load}")
        last = done[-1]
        self._commit((load, last.next_merchant_id, last.next_price_id, 0, 0, 0, None, None, load))
        return load

    def merchants(self, done: list | None = None) -> DataFrame:
        done = self._committed() if done is None else done
        folders = [self._path("merchants", f"load={c.load}") for c in done if c.products_base is None]
        return self._read("merchants", MERCHANTS, folders)

    def price_history(self, done: list | None = None) -> DataFrame:
        done = self._committed() if done is None else done
        folders = [self._path("price_history", f"load={c.load}") for c in done if c.inserted]
        return self._read("price_history", PRICE_HISTORY, folders)

    def facts(self) -> DataFrame:
        """Price history with product and merchant names, for the price questions."""
        done = self._committed()
        return star(self.price_history(done), self.products(done), self.merchants(done))

    def rejects(self, load: int) -> DataFrame:
        return self.spark.read.parquet(self._path("rejects", f"load={load}"))

    # --- loading ---

    def load(
        self,
        clean_rows: DataFrame,
        load: int | None = None,
        policy: str = "quarantine",
        batch: str | None = None,
    ) -> LoadResult:
        """Load clean observations; rows already stored are skipped.

        ``clean_rows`` is read several times and should be a stored table. Rows that
        cannot become facts are kept as rejects; under the ``strict`` policy a row
        without a product id fails the load. A ``batch`` that was committed before is not
        loaded again; its first result is returned.
        """
        done = self._committed()
        for known in done if batch is not None else []:
            if known.batch == batch:
                skipped = known.received - known.rejected - known.inserted
                return LoadResult(known.load, known.received, known.inserted, skipped, known.rejected)
        load = load if load is not None else (done[-1].load + 1 if done else 1)
        if any(c.load == load for c in done):
            raise LoadRejected(f"Load {load} is already committed")
        now = F.current_timestamp()

        stamped = dim_products(clean_rows).withColumns({"created_at": now, "updated_at": now})
        self._write(stamped, "products", f"load={load}")

        known = self.merchants(done)
        next_id = done[-1].next_merchant_id if done else 1
        seen = Observation()
        # Names are numbered by a plan that uses them twice.
        names = self._kept(dim_merchants(clean_rows), "names")
        added = new_merchants(known, names, now, first_id=next_id)
        self._write(added.observe(seen, F.count(F.lit(1)).alias("rows")), "merchants", f"load={load}")
        next_id += seen.get["rows"]
        added = self._read("merchants", MERCHANTS, [self._path("merchants", f"load={load}")])

        # Typed, mapped and judged once; rejects and facts are both read from it.
        seen = Observation()
        prepared = prepare_facts(clean_rows, known.unionByName(added))
        watched = prepared.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count("reject_reason").alias("refused"),
            F.count(F.when(F.col("reject_reason") == "product_missing", 1)).alias("missing"),
        )
        self._write(watched, "staged", "prepared")
        received, refused, missing = (seen.get[name] for name in ("rows", "refused", "missing"))
        prepared = self.spark.read.schema(prepared.schema).parquet(self._path("staged", "prepared"))
        self._write(prepared.where(F.col("reject_reason").isNotNull()), "rejects", f"load={load}")
        if policy == "strict" and missing:
            raise LoadRejected(f"{missing} rows have no product id")

        fresh = distinct_keys(loadable(prepared), stored=True)
        if done:  # only then they are read again and again
            self._write(fresh, "staged", "facts")
            facts = self.spark.read.parquet(self._path("staged", "facts"))
            fresh = new_facts(facts, self._same_months(facts, done))
            if fresh is not facts:  # the range partitioner would do the comparison twice
                fresh = self._kept(fresh, "fresh")
        first_price = done[-1].next_price_id if done else 1
        inserted = self._append_facts(fresh, load, first_price)
        self._commit((load, next_id, first_price + inserted, received, inserted, refused, None, batch, None))
        return LoadResult(load, received, inserted, received - refused - inserted, refused)

    def _commit(self, record: tuple) -> None:
        commit = self.spark.createDataFrame([record], COMMITS).withColumn("committed_at", F.current_timestamp())
        commit.coalesce(1).write.mode("append").json(self._path("commits"))

    def _write(self, rows: DataFrame, *folder: str, by: Iterable[str] = ()) -> None:
        # Overwriting makes a repeated, uncommitted load start clean.
        writer = rows.write.mode("overwrite").options(**COMPACT, maxRecordsPerFile=ROWS_PER_FILE)
        writer.partitionBy(*by).parquet(self._path(*folder))

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows as a stored table, for a plan that would compute them twice."""
        self._write(rows, "staged", name)
        return self.spark.read.schema(rows.schema).parquet(self._path("staged", name))

    def _same_months(self, facts: DataFrame, done: list) -> DataFrame:
        """Stored facts of the months a batch touches, so that no others are read.

        Observation times are bounded by the parser, so there are at most 7,032 months.
        """
        stored = self.price_history(done)
        touched = facts.select(F.year("observed_at"), F.month("observed_at")).distinct().collect()
        by_year: dict[int, list[int]] = {}
        for year, month in touched:
            by_year.setdefault(year, []).append(month)
        keep = F.lit(False)
        for year, months in sorted(by_year.items()):
            keep = keep | ((F.col("observed_year") == year) & F.col("observed_month").isin(months))
        return stored.where(keep)

    def _append_facts(self, fresh: DataFrame, load: int, first_price: int) -> int:
        """Store facts of new load keys under ids that follow each other without gaps; return their number.

        Facts are laid out and written once with their place inside the task that wrote them.
        Counts per task give each task its first id, and a second pass over the written files
        adds the two: a repeated task finds the same files and gives the same ids.
        """
        task = F.spark_partition_id()
        # Year and month are added after the shuffle, so that rows of keys only are moved.
        by_time = [F.expr(FROM_TIME.get(c, c)) for c in LAYOUT]
        laid_out = (
            dated(fresh.repartitionByRange(*by_time))
            .sortWithinPartitions(*LAYOUT)
            .withColumns({"_task": task, "_row": F.monotonically_increasing_id() - F.shiftleft(task.cast("long"), 33)})
        )
        self._write(laid_out, "staged", "numbered")
        numbered = self.spark.read.schema(laid_out.schema).parquet(self._path("staged", "numbered"))
        # One row per task that wrote facts.
        sizes = numbered.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.orderBy("_task"))
        starts = sizes.withColumns({"_start": upto - F.col("_n"), "_all": upto}).persist()
        inserted = starts.agg(F.coalesce(F.max("_all"), F.lit(0))).first()[0]
        facts = numbered.join(starts.select("_task", "_start"), "_task").withColumns(
            {
                "price_id": F.lit(first_price) + F.col("_start") + F.col("_row"),
                "created_at": F.current_timestamp(),
            }
        )
        folder = f"load={load}"
        by = ["observed_year", "observed_month"]
        ordered = facts.drop("_task", "_row", "_start").sortWithinPartitions(*LAYOUT)
        self._write(ordered, "price_history", folder, by=by)
        starts.unpersist()
        require_loadable(self._read("price_history", PRICE_HISTORY, [self._path("price_history", folder)]))
        return inserted


def export_jdbc(
    rows: DataFrame, url: str, table: str, batch_rows: int = 1000, **properties: str
) -> None:
    """Append a table to a database that Spark has a JDBC driver for."""
    writer = rows.write.format("jdbc").options(url=url, dbtable=table, **properties)
    writer.option("batchsize", batch_rows).mode("append").save()
