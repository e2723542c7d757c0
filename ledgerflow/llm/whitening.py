"""Whitened embeddings by distributed block matrices.

Entries are taken as integers, x = floor(scale * c) + shift, so that counts, sums and
squared deviations are exact. The centred rows become the blocks of an MLlib
`BlockMatrix`: every task cuts its own rows into blocks, the last filled up with zero rows, so building the matrix moves no row. The written blocks are read back as
matrices by the JVM; Python sees arrays only. From there:

- scatter: the transpose times the matrix. Its middle dimension, the rows, is split
  into groups of `GROUP_BLOCKS` blocks, each a small square that is summed up; without
  the split MLlib would bring all rows to the one task of the result;
- eigenvectors: of the scatter over n, by `eigh` on the driver (dimensions squared);
- projection: the matrix times the whitening matrix, the eigenvectors over the roots
  of their eigenvalues.

Multiplying moves the blocks three times in all (both factors of the scatter, and the
rows of the projection): that is how MLlib multiplies. It also lists the places of the
blocks on the driver, so blocks grow where there would be more than `MOST_BLOCKS`.

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry
take no part, nor do entries too large to scale exactly (`LARGEST`). Vectors must have
one length: rows of another length than the most frequent one (the longest, if tied)
take no part. Repeated and null vec_ids are rows like any others. A component whose
eigenvalue is zero to double precision (a constant direction; all, if there is one row
only) cannot be whitened and is left out. Other columns of the input are not read,
whatever their names. No rows give no rows.
"""

from __future__ import annotations

import decimal
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import stable, work_dir

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
BLOCK_ROWS = 1024  # at least
MOST_BLOCKS = 1 << 20
BLOCK_COLUMNS = 1024
GROUP_BLOCKS = 16  # blocks of rows that one task multiplies
LARGEST = 2.0**43

# The fields of MLlib's matrix type.
MATRIX = "struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,values:array<double>,isTransposed:boolean>"


class Fit(NamedTuple):
    """What the fit list says: rows, exact sums, eigenvalues and unit eigenvectors (columns), greatest first."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    c = F.col("embedding")
    wrong = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(LARGEST)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), c.cast("array<double>").alias("embedding"))
    rows = rows.where(c.isNotNull() & (F.size(c) > 0) & ~wrong)
    # One row for each length that occurs.
    lengths = rows.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size(c) == (lengths["d"] if lengths else 0))


def whole(x: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    return F.floor(F.lit(float(scale)) * x) + F.lit(shift)


def column_sums(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int]]:
    """The number of rows, and the exact sum of every dimension."""
    got = (
        rows.select(F.posexplode("embedding").alias("at", "c")).groupBy("at")
        .agg(F.count("*").alias("n"), F.sum(whole(F.col("c"), scale, shift).cast("decimal(38,0)")).alias("s"))
        .orderBy("at").collect()  # one row a dimension
    )
    return (got[0]["n"], [int(r["s"]) for r in got]) if got else (0, [])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """For each row of x the sum over dimensions of (n * x - S)^2, exact."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if 4 * most * most * x.shape[1] < 1 << 62:
        d = n * x - np.array(sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    if 2 * most < 1 << 62:
        d = n * x - np.array(sums, dtype=np.int64)
        if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
            return (d * d).sum(axis=1).tolist()
        d = d.astype(object)
    else:
        d = n * x.astype(object) - np.array(sums, dtype=object)
    return [int(v) for v in (d * d).sum(axis=1)]


BLOCKS = (
    "part int, block int, col int, vec_ids array<long>, deviations array<decimal(38,0)>, "
    f"matrix {MATRIX}"
)


def write_blocks(rows: DataFrame, n: int, sums: list[int], scale: int = SCALE, shift: int = SHIFT, block_rows: int = BLOCK_ROWS) -> str:
    """The centred rows in blocks, as parquet in the shared folder; the place of the table.

    A row is one block: its ids and exact deviations (in the first block of columns
    only) and its matrix, row by row.
    """
    spark = rows.sparkSession
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    d = len(sums)
    matrix = pa.struct([
        ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
        ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
    ])
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("col", pa.int32()), ("vec_ids", pa.list_(pa.int64())),
        ("deviations", pa.list_(pa.decimal128(38, 0))), ("matrix", matrix),
    ])
    total = spark.sparkContext.broadcast(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, sums = TaskContext.get().partitionId(), 0, total.value
        # S/n as a whole part and a rest: x less the whole part is exact, and small.
        base = [s // n for s in sums]
        rest = np.array([(s - b * n) / n for s, b in zip(sums, base)])
        base = np.array(base, dtype=np.int64)
        ids: list = []
        held: list[np.ndarray] = []
        count = 0

        def cut(size: int) -> pa.RecordBatch:
            nonlocal held, count, block
            x = np.concatenate(held)
            own, held, count = x[:size], [x[size:]], len(x) - min(size, len(x))
            names = ids[: len(own)]
            del ids[: len(own)]
            centred = np.zeros((block_rows, d))
            centred[: len(own)] = (own - base) - rest
            far = [decimal.Decimal(v) for v in deviations(own, n, sums)]
            out = []
            for col, first in enumerate(range(0, d, BLOCK_COLUMNS)):
                values = centred[:, first : first + BLOCK_COLUMNS]
                cell = {
                    "type": 1, "numRows": block_rows, "numCols": values.shape[1], "colPtrs": None, "rowIndices": None,
                    "values": values.reshape(-1), "isTransposed": True,
                }
                out.append({
                    "part": part, "block": block, "col": col, "vec_ids": names if col == 0 else None,
                    "deviations": far if col == 0 else None, "matrix": cell,
                })
            block += 1
            return pa.RecordBatch.from_pylist(out, schema=schema)

        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            held.append((np.floor(float(scale) * values)).astype(np.int64) + shift)
            ids.extend(batch.column(0).to_pylist())
            count += batch.num_rows
            while count >= block_rows:
                yield cut(block_rows)
        if count:
            yield cut(count)

    rows.select("vec_id", "embedding").mapInArrow(run, BLOCKS).write.parquet(path)
    return path


def numbered(blocks: DataFrame) -> DataFrame:
    """The blocks with `row`, their place among all blocks of rows (0, 1, ...)."""
    # One row a task that wrote blocks.
    counts = blocks.groupBy("part").agg(F.max("block").alias("last")).orderBy("part").collect()
    before, offsets = 0, []
    for r in counts:
        offsets.append((r["part"], before))
        before += r["last"] + 1
    starts = blocks.sparkSession.createDataFrame(offsets or [(0, 0)], "part int, before int")
    return blocks.join(F.broadcast(starts), "part").withColumn("row", F.col("block") + F.col("before"))


def distributed(cells: DataFrame, block_rows: int, block_columns: int, n_rows: int, n_columns: int) -> BlockMatrix:
    """A matrix from a frame of ((row, column), matrix); the wrapper itself takes an RDD of Python objects only."""
    made = callMLlibFunc("createBlockMatrix", cells, block_rows, block_columns, n_rows, n_columns)
    return BlockMatrix(made, block_rows, block_columns)


def block_matrix(spark: SparkSession, path: str, block_rows: int, d: int) -> tuple[BlockMatrix, int]:
    """The written blocks as a distributed matrix, and its number of row blocks."""
    plain = T._parse_datatype_string(BLOCKS)
    # The same bytes, read as MLlib's matrices.
    typed = T.StructType([T.StructField(f.name, MatrixUDT() if f.name == "matrix" else f.dataType) for f in plain])
    blocks = numbered(spark.read.schema(typed).parquet(path).select("part", "block", "col", "matrix"))
    n_blocks = spark.read.schema(plain).parquet(path).where("col = 0").count()
    place = F.struct(F.col("row").cast("long").alias("_1"), F.col("col").cast("long").alias("_2"))
    cells = blocks.select(place.alias("_1"), F.col("matrix").alias("_2"))
    return distributed(cells, block_rows, min(d, BLOCK_COLUMNS), n_blocks * block_rows, d), n_blocks


def multiply(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a times b, with the middle dimension cut into `splits` parts that are multiplied apart.

    MLlib's own argument, which the Python wrapper does not pass on.
    """
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(a: BlockMatrix, n_blocks: int) -> np.ndarray:
    """The transpose of the matrix times itself."""
    got = multiply(a.transpose(), a, max(1, -(-n_blocks // GROUP_BLOCKS))).toLocalMatrix().toArray()
    return (got + got.T) / 2


def eigen(scattered: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Greatest eigenvalues of scattered / n that are not zero, their vectors, and the trace."""
    covariance = scattered / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = max(values[0], 0.0) * len(values) * np.finfo(float).eps * 16
    keep = min(components, int((values > least).sum()))
    return values[:keep], np.ascontiguousarray(vectors[:, :keep]), float(np.trace(covariance))


WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, block_rows: int | None = None
) -> tuple[DataFrame, Fit]:
    """Whitened rows of `embeddings` (vec_id, embedding), and the fit.

    One row for each remaining row and component: vec_id, component (from 1), n,
    deviation (exact), whitened, explained, identity_error.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    n, sums = column_sums(rows, scale, shift)
    empty = spark.createDataFrame([], WHITENED)
    if not n:
        return empty, Fit(0, np.empty(0), np.empty(0), np.empty((0, 0)), 0.0)
    d = len(sums)
    block_rows = block_rows or max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    path = write_blocks(rows, n, sums, scale, shift, block_rows)
    a, n_blocks = block_matrix(spark, path, block_rows, d)
    values, vectors, trace = eigen(scatter(a, n_blocks), n, components)
    fit = Fit(n, np.array(sums), values, vectors, trace)
    keep = len(values)
    if not keep:
        return empty, fit
    by = min(d, BLOCK_COLUMNS)
    matrix = vectors / np.sqrt(values)
    cells = [((i, 0), Matrices.dense(len(m), keep, m.reshape(-1, order="F").tolist())) for i, m in enumerate(np.split(matrix, range(by, d, by)))]
    whitening = distributed(spark.createDataFrame(cells), by, keep, d, keep)
    got = callMLlibFunc("getMatrixBlocks", a.multiply(whitening)._java_matrix_wrapper._java_model)
    out = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    got.select(F.col("_1._1").alias("row"), F.col("_2").alias("matrix")).write.parquet(out)
    # A product's values stand column by column, unless it says otherwise.
    made = spark.read.schema(f"row int, matrix {MATRIX}").parquet(out)
    names = numbered(spark.read.schema(BLOCKS).parquet(path).where("col = 0").select("part", "block", "vec_ids", "deviations"))
    m = F.col("matrix")
    cell = [
        F.get(m["values"], F.when(m["isTransposed"], F.col("at") * keep + k).otherwise(F.col("at") + k * block_rows)).alias(f"w{k}")
        for k in range(keep)
    ]
    each = F.posexplode(F.arrays_zip("vec_ids", "deviations")).alias("at", "of")
    flat = stable(
        names.join(made, "row").select("matrix", each)
        .select(F.col("of.vec_ids").alias("vec_id"), F.col("of.deviations").alias("deviation"), *cell)
    )
    error = identity_error(flat, [f"w{k}" for k in range(keep)])
    explained = [float(v / trace) for v in values]
    one = F.explode(F.array(*[
        F.struct(F.lit(k + 1).alias("component"), F.col(f"w{k}").alias("whitened"), F.lit(explained[k]).alias("explained"))
        for k in range(keep)
    ])).alias("of")
    result = flat.select("vec_id", "deviation", one).select(
        "vec_id", "of.component", F.lit(n).cast("long").alias("n"), "deviation", "of.whitened", "of.explained",
        F.lit(error).alias("identity_error"),
    )
    return result, fit


def identity_error(rows: DataFrame, names: list[str]) -> float:
    """The largest absolute entry of the columns' covariance less the identity."""
    mean = rows.agg(*[F.avg(c).alias(c) for c in names]).first()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    centred = [F.col(c) - F.lit(mean[c]) for c in names]
    got = rows.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(got, pairs))
