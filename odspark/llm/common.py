"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.session import ensure_checkpoint_dir

SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the folder that all executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than one in HEAVY_SHARE of all rows is heavy; there are fewer than HEAVY_SHARE such keys, whatever the input.
HEAVY_SHARE = 1024


def keyed_join(left: DataFrame, right: DataFrame, key: str, rows: str, how: str = "inner") -> DataFrame:
    """`left` joined with `right` on `key`, inner or left; right: one row per key, with the number of left rows of the key in column `rows`.

    The right rows of heavy keys (fewer than HEAVY_SHARE) are broadcast, so no key gathers a large part of `left` in one task; the
    other left rows meet the other right rows through a shuffle. Rows without a key match nothing. `left` and `right` are read twice: give stored tables.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    is_heavy = F.col(rows).cast("decimal(38,0)") * HEAVY_SHARE > F.lit(total).cast("decimal(38,0)")
    heavy, light = F.broadcast(right.where(is_heavy).drop(rows)), right.where(~is_heavy).drop(rows)
    if light.isEmpty():
        return left.join(heavy, key, how)
    rest = left.where(F.col(key).isNotNull()).join(heavy.select(key), key, "left_anti").join(light, key, how)
    if how == "left":
        rest = rest.unionByName(left.where(F.col(key).isNull()).join(heavy, key, "left"))
    return left.join(heavy, key).unionByName(rest)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def space_words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text as an array (empty for a text without words)."""
    rare = "[\t\x0b\f\r]"
    text = F.when(text.rlike(rare), F.regexp_replace(text, rare, " ")).otherwise(text)
    return F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")


#: Bytes of the texts that one generation of a worker's memo holds, about.
MEMO_BYTES = 6 << 20
#: Longer texts are not remembered.
MEMO_TEXT = 64


class Memo(dict):
    """Text -> what `make` gives for it, in two generations: when the remembered texts exceed `limit` bytes (their keys and values cost a few times that) the
    generation before goes, and what is asked for again moves from the old one to the new one."""

    def __init__(self, make, limit: int = MEMO_BYTES):
        self.make, self.held, self.limit, self.old = make, 0, limit, {}

    def __missing__(self, text):
        value = self.old.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= MEMO_TEXT:
            self._room(len(text) + 32)
            self[text] = value
        return value

    def _room(self, size: int) -> None:
        if self.held > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += size

    def known(self, text):
        """What is remembered for a text (moved to this generation), or None."""
        return self[text] if text in self or text in self.old else None

    def keep_all(self, values: dict) -> None:
        """Remember values that were made elsewhere."""
        values = {t: v for t, v in values.items() if len(t) <= MEMO_TEXT}
        self._room(sum(map(len, values)) + 32 * len(values))
        self.update(values)


_HELD: dict = {}   # of this Python worker


def held(owner: str, key, make):
    """What `make` gives for a key, kept in this worker as long as the same operator (`owner`) runs in it: a worker that Spark reuses for another operator drops it."""
    if _HELD.get("owner") != owner:
        _HELD.clear()
        _HELD["owner"] = owner
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


#: Rows of one Arrow batch at most: keeps a batch of very long texts small in Python workers.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Python operators see at most ARROW_ROWS documents at a time (a runtime setting of the session)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def add_columns(df: DataFrame, col: str, fields: str, per_text, chunk_bytes: int = 0) -> DataFrame:
    """`df` with the columns of `fields` ("name type, ..."), which per_text(list of UTF-8 bytes or None) gives as a list per column.

    All columns of `df` pass through unchanged; a column of the same name is replaced. Runs in Arrow batches, without a shuffle; with `chunk_bytes`
    per_text sees as many batches at a time as hold about that many bytes.
    """
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    added = StructType.fromDDL(fields)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in added.names]) if set(added.names) & set(df.columns) else df
    at = kept.columns.index(col)
    schema = StructType([*kept.schema.fields, *added.fields])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(added)

        def widened(chunk):
            columns = per_text([t for b in chunk for t in b.column(at).cast(pa.binary()).to_pylist()])
            done = 0
            for b in chunk:
                new = [pa.array(v[done:done + b.num_rows], f.type) for v, f in zip(columns, types, strict=True)]
                done += b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *added.names])

        chunk, size = [], 0
        for b in batches:
            chunk.append(b)
            size += b.nbytes
            if size >= chunk_bytes:
                yield from widened(chunk)
                chunk, size = [], 0
        if chunk:
            yield from widened(chunk)

    return kept.mapInArrow(run, schema)
