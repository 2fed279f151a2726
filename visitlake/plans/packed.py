"""The encoded extract as bytes: fixed-width column chunks with their offsets.

Visits get consecutive positions, and ``ROWS`` positions are a chunk. A chunk of a column is
one binary value: the codes of its rows one after the other, little-endian, in as many bytes as
the column's codes need. Values are turned into hexadecimal text row by row, put in order
inside the bounded chunk and turned into bytes together, so the work is built-in functions on
groups of fixed size, however many visits there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.operators.windows import numbered
from visitlake.plans.crossfilter import Encoding

ROWS = 4096
#: Rows of a chunk that are unpacked together.
BLOCK = 64


def widths(coding: Encoding, doctor: int = 1, patient: int = 2) -> dict[str, int]:
    """Bytes of each column, in the order of the extract. Doctors and patients are as wide as their dictionaries need."""
    return {"dept": 1, "pay": 1, "age": 1, "doctor": doctor, "sat": 1, "wait": 1, "monthweek": 1, "bill": coding.bill_bytes, "patient": patient}


def width_of(codes: int) -> int:
    """Bytes that hold the codes from 0 to ``codes - 1``."""
    return max(1, ((max(codes, 1) - 1).bit_length() + 7) // 8)


def little_endian(code: Column, width: int) -> Column:
    """A code as the hexadecimal digits of its bytes, the lowest byte first. Stops at one the width does not hold."""
    fits = code.between(0, 256**width - 1)
    message = F.concat(F.coalesce(code.cast("string"), F.lit("no code")), F.lit(f" does not fit {width} bytes"))
    checked = F.when(fits, code.cast("bigint")).otherwise(F.raise_error(message))
    one = lambda i: F.lpad(F.hex(F.shiftright(checked, 8 * i).bitwiseAND(255)), 2, "0")
    return F.concat(*(one(i) for i in range(width)))


def pack(encoded: DataFrame, sizes: dict[str, int], key: str = "VisitID", rows: int = ROWS) -> DataFrame:
    """``Chunk, ColumnName, Width, FirstRow, Rows, Bytes``: a row for each chunk and column.

    Rows stand in the order of ``key`` and are numbered over all tasks; rows of one key take
    a place each. A chunk is gathered by one task, ``rows`` of them at a time.
    """
    placed = numbered(encoded.select(key, *sizes), [key, *sizes], "_at")
    chunk, inside = F.floor(F.col("_at") / rows).cast("bigint"), (F.col("_at") % rows).cast("int")
    cells = F.struct(inside.alias("_at"), *(little_endian(F.col(name), width).alias(name) for name, width in sizes.items()))
    gathered = placed.select(chunk.alias("Chunk"), cells.alias("_row")).groupBy("Chunk").agg(
        F.array_sort(F.collect_list("_row")).alias("_rows"), F.count(F.lit(1)).alias("Rows"))
    columns = F.array(*(
        F.struct(F.lit(name).alias("ColumnName"), F.lit(width).alias("Width"),
                 F.unhex(F.array_join(F.col(f"_rows.{name}"), "")).alias("Bytes"))
        for name, width in sizes.items()))
    out = gathered.select("Chunk", "Rows", F.inline(columns))
    return out.select("Chunk", "ColumnName", "Width", (F.col("Chunk") * rows).alias("FirstRow"), "Rows", "Bytes")


def unpack(packed: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The codes again as whole numbers, with the ``Row`` each has: one column for each of ``sizes``.

    A chunk is cut into blocks of ``BLOCK`` rows before its codes are read, since every reading of a code
    passes over the value it is cut from; the lists of a block's codes are then rows side by side.
    """
    parts = packed.groupBy("Chunk", "FirstRow", "Rows").agg(*(
        F.max(F.when(F.col("ColumnName") == name, F.col("Bytes"))).alias(f"_{name}") for name in sizes))
    block = lambda at: F.struct((F.col("FirstRow") + at).alias("_first"), *(
        F.substring(F.col(f"_{name}"), at * width + 1, F.lit(BLOCK * width)).alias(f"_{name}") for name, width in sizes.items()))
    blocks = parts.select(F.inline(F.transform(F.sequence(F.lit(0), F.col("Rows").cast("int") - 1, F.lit(BLOCK)), block)))

    def codes(name: str, width: int) -> Column:
        digits = lambda at: F.hex(F.substring(F.col(f"_{name}"), at, F.lit(1)))
        whole = lambda at: digits(at) if width == 1 else F.concat(*(digits(at + i) for i in reversed(range(width))))
        starts = F.sequence(F.lit(1), F.length(f"_{name}") - width + 1, F.lit(width))
        return F.transform(starts, lambda at: F.conv(whole(at), 16, 10).cast("int" if width < 4 else "bigint")).alias(name)

    lists = blocks.select("_first", F.arrays_zip(*(codes(name, width) for name, width in sizes.items())).alias("_codes"))
    rows = lists.select("_first", F.posexplode("_codes").alias("_i", "_code"))
    return rows.select((F.col("_first") + F.col("_i")).alias("Row"), *(F.col(f"_code.{name}").alias(name) for name in sizes))


def totals(packed: DataFrame) -> DataFrame:
    """``ColumnName, Width, Chunks, Rows, Size, Gaps``: what the chunks of each column come to, and the
    chunks whose bytes are not their rows times the width."""
    bad = F.length("Bytes") != F.col("Rows") * F.col("Width")
    return packed.groupBy("ColumnName", "Width").agg(
        F.count(F.lit(1)).alias("Chunks"), F.sum("Rows").alias("Rows"), F.sum(F.length("Bytes")).cast("bigint").alias("Size"),
        F.count_if(bad).alias("Gaps"))
