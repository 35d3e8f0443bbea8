"""Hash cells of keys: which part of the key space some rows touch, as a constant that plans can filter by."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.columns import cols

WORD = 64


def key_cell(keys: Sequence[str], cells: int) -> Column:
    """The cell, from 0 to `cells` - 1, of a key; equal keys share one, NULLs included."""
    return F.pmod(F.xxhash64(*cols(keys)), F.lit(cells)).cast("int")


def told_apart(value: Column, dtype: T.DataType) -> Column:
    """`value` in a form whose hash tells NULLs and empty arrays apart at any depth, over which hashes pass otherwise."""
    parts = [value.isNull()]
    if isinstance(dtype, T.ArrayType):
        parts += [F.size(value), F.transform(value, lambda x: told_apart(x, dtype.elementType))]
    elif isinstance(dtype, T.StructType):
        parts += [told_apart(value.getField(f.name), f.dataType) for f in dtype.fields]
    else:
        parts.append(value)
    return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])


def in_cells(cell: Column, chosen: Iterable[int], cells: int) -> Column:
    """Whether a cell is one of the chosen: a bit of a constant of `cells` bits, tested without a join."""
    words = [0] * -(-cells // WORD)
    for c in chosen:
        words[c // WORD] |= 1 << (c % WORD)
    if not any(words):
        return F.lit(False)
    signed = [w - (1 << WORD) if w >> (WORD - 1) else w for w in words]
    bits = F.split(F.lit(",".join(map(str, signed))), ",").cast("array<long>")
    word = F.get(bits, F.floor(cell / WORD).cast("int"))
    return F.bit_get(word, F.pmod(cell, F.lit(WORD)).cast("int")) == 1
