"""Per-batch payload schema inference (JVM-side) and schema evolution rules.

Inference runs `schema_of_variant_agg(try_parse_json(image))` as one aggregate:
no Python worker, no RDD, partial aggregation on every partition. The variant
type string is then normalised to the types the JSON reader would give:

  DECIMAL(p, s>0)            -> DOUBLE   (fractional number)
  DECIMAL(p<=20, 0)          -> DOUBLE, if a value is written with a point or an
                                exponent (100.0); DECIMAL(20, 0) otherwise, a whole
                                number beyond BIGINT, kept exactly
  DECIMAL(p>20, 0)           -> DECIMAL(p, 0) (very large integer)
  VOID                       -> STRING   (all null; or left void, so that a later type counts)
  VARIANT                    -> STRING   (conflicting types; from_json yields the raw text)
  OBJECT<...>                -> STRUCT<...>, empty objects dropped
  ARRAY<T>                   -> ARRAY<normalised T>
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = {
    "BIGINT": T.LongType(),
    "INT": T.LongType(),
    "SMALLINT": T.LongType(),
    "TINYINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "VOID": T.NullType(),
    "VARIANT": T.StringType(),
    "DATE": T.StringType(),
    "TIMESTAMP": T.StringType(),
    "TIMESTAMP_NTZ": T.StringType(),
    "BINARY": T.StringType(),
}

_WHOLE = T.DecimalType(20, 0)

_DECIMAL = re.compile(r"DECIMAL\((\d+),\s*(\d+)\)")


class _TypeReader:
    """Reads the variant type string one token at a time."""

    def __init__(self, text: str):
        self.s = text
        self.i = 0

    def _ws(self) -> None:
        while self.i < len(self.s) and self.s[self.i] == " ":
            self.i += 1

    def _peek(self, lit: str) -> bool:
        self._ws()
        return self.s.startswith(lit, self.i)

    def _take(self, lit: str) -> None:
        self._ws()
        if not self.s.startswith(lit, self.i):
            raise ValueError(f"expected {lit!r} at {self.i} in {self.s!r}")
        self.i += len(lit)

    def _name(self) -> str:
        self._ws()
        if self.s[self.i] == "`":
            out = []
            self.i += 1
            while True:
                ch = self.s[self.i]
                if ch == "`":
                    if self.s.startswith("``", self.i):
                        out.append("`")
                        self.i += 2
                        continue
                    self.i += 1
                    return "".join(out)
                out.append(ch)
                self.i += 1
        start = self.i
        while self.i < len(self.s) and self.s[self.i] not in ":":
            self.i += 1
        return self.s[start:self.i].strip()

    def read(self) -> T.DataType | None:
        self._ws()
        if self._peek("OBJECT<"):
            self._take("OBJECT<")
            fields = []
            while not self._peek(">"):
                name = self._name()
                self._take(":")
                dtype = self.read()
                if dtype is not None:
                    fields.append(T.StructField(name, dtype, True))
                if self._peek(","):
                    self._take(",")
            self._take(">")
            return T.StructType(fields) if fields else None
        if self._peek("ARRAY<"):
            self._take("ARRAY<")
            inner = self.read()
            self._take(">")
            return T.ArrayType(inner if inner is not None else T.StringType(), True)
        m = _DECIMAL.match(self.s, self.i)
        if m:
            self.i = m.end()
            precision, scale = int(m.group(1)), int(m.group(2))
            if scale > 0:
                return T.DoubleType()
            # up to 20 digits: a large integer or a number like 100.0, see _settled
            return _WHOLE if precision <= 20 else T.DecimalType(min(precision, 38), 0)
        start = self.i
        while self.i < len(self.s) and self.s[self.i] not in ",> ":
            self.i += 1
        word = self.s[start:self.i]
        if word not in _SIMPLE:
            return T.StringType()
        return _SIMPLE[word]


def _mapped(dtype: T.DataType, leaf) -> T.DataType:
    """`dtype` with every leaf type replaced by `leaf(type)`."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _mapped(f.dataType, leaf), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_mapped(dtype.elementType, leaf), True)
    return leaf(dtype)


def _has_whole(dtype: T.DataType) -> bool:
    found = []
    _mapped(dtype, lambda t: found.append(t == _WHOLE) or t)
    return any(found)


def variant_type_to_struct(text: str | None, *, exact: frozenset[str] = frozenset(), keep_void: bool = False) -> T.StructType | None:
    """Normalise a `schema_of_variant_agg` result to a payload StructType.

    `exact`: columns whose whole numbers are integers. `keep_void`: leave
    columns without any value void instead of calling them strings.
    """
    if not text:
        return None
    dtype = _TypeReader(text).read()
    if not isinstance(dtype, T.StructType) or not dtype.fields:
        return None

    def settled(name: str, top: T.DataType) -> T.DataType:
        if keep_void and isinstance(top, T.NullType):
            return top
        return _mapped(top, lambda t: T.StringType() if isinstance(t, T.NullType)
                       else T.DoubleType() if t == _WHOLE and name not in exact else t)

    return T.StructType([T.StructField(f.name, settled(f.name, f.dataType), True) for f in dtype.fields])


def infer_payload_schema(batch: DataFrame, column: str = "_row_json", *, keep_void: bool = False) -> T.StructType | None:
    """Schema of this batch's row images; None when empty or nothing parses.

    One aggregate job (partial per partition, final on one small row), and a
    second one only when a column holds whole numbers that might be integers
    beyond BIGINT: its text tells.
    """
    row = batch.agg(_variant_type(column)).first()
    text = row["s"] if row else None
    exact: frozenset[str] = frozenset()
    if doubtful := _doubtful(text):
        pointed = batch.agg(*_pointed(column, doubtful)).first()
        exact = frozenset(n for i, n in enumerate(doubtful) if not pointed[f"c{i}"])
    return variant_type_to_struct(text, exact=exact, keep_void=keep_void)


def infer_payload_schemas(batch: DataFrame, by: str, column: str = "_row_json", *, keep_void: bool = False) -> dict[int, T.StructType]:
    """`infer_payload_schema` of each part of a batch, by the same one or two aggregates, grouped; parts that give none are left out.

    A short text per part comes to the driver.
    """
    texts = {r[by]: r["s"] for r in batch.groupBy(by).agg(_variant_type(column)).collect()}
    doubtful = sorted({n for text in set(texts.values()) for n in _doubtful(text)})
    exact: dict[int, frozenset[str]] = {}
    if doubtful:
        exact = {r[by]: frozenset(n for i, n in enumerate(doubtful) if not r[f"c{i}"]) for r in batch.groupBy(by).agg(*_pointed(column, doubtful)).collect()}
    found = {part: variant_type_to_struct(text, exact=exact.get(part, frozenset()) & set(_doubtful(text)), keep_void=keep_void) for part, text in texts.items()}
    return {part: schema for part, schema in found.items() if schema is not None}


def _variant_type(column: str) -> Column:
    return F.expr(f"schema_of_variant_agg(try_parse_json(`{column}`))").alias("s")


def _doubtful(text: str | None) -> list[str]:
    """Columns of whole numbers that might be integers beyond BIGINT."""
    raw = _TypeReader(text).read() if text else None
    return [f.name for f in raw.fields if _has_whole(f.dataType) and "'" not in f.name] if isinstance(raw, T.StructType) else []


def _pointed(column: str, names: Sequence[str]) -> list[Column]:
    """Whether some number of a column is written with a point or an exponent."""
    return [F.bool_or(F.get_json_object(column, f"$['{n}']").rlike(r"[0-9](\.|[eE])")).alias(f"c{i}") for i, n in enumerate(names)]


def widen(stored: T.DataType, incoming: T.DataType) -> T.DataType:
    """Type of a column when a batch of type `incoming` meets a table of type
    `stored` (E5): nothing that fits either type is lost. Integers and larger
    integers become a wider decimal, integers and fractions double, structs gain
    fields, arrays widen their elements, and whatever else clashes becomes text."""
    if stored == incoming or isinstance(incoming, T.NullType):
        return stored
    if isinstance(stored, T.NullType):
        return incoming
    if isinstance(stored, T.StructType) and isinstance(incoming, T.StructType):
        return evolve(stored, incoming)
    if isinstance(stored, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(widen(stored.elementType, incoming.elementType), True)
    types = (stored, incoming)
    if all(isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) for t in types):
        return T.LongType()
    if all(isinstance(t, T.IntegralType) or (isinstance(t, T.DecimalType) and t.scale == 0) for t in types):
        return T.DecimalType(max(20, *(t.precision for t in types if isinstance(t, T.DecimalType))), 0)
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    return T.StringType()


def evolve(target: T.StructType | None, batch: T.StructType, *, keys: Sequence[str] = ()) -> T.StructType:
    """Running union of schemas (E3/E7). Types widen, but for `keys`: a key's
    type decides what is the same row, so the first one stays. A new column that
    has no value yet is text."""
    known = {f.name: f.dataType for f in target.fields} if target is not None else {}
    incoming = {f.name: f.dataType for f in batch.fields}
    out = []
    for name in [*known, *(n for n in incoming if n not in known)]:
        if name not in known:
            dtype = T.StringType() if isinstance(incoming[name], T.NullType) else incoming[name]
        elif name in incoming and name not in keys:
            dtype = widen(known[name], incoming[name])
        else:
            dtype = known[name]
        out.append(T.StructField(name, dtype, True))
    return T.StructType(out)


def conform_column(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """`col` (of type `have`) as type `want`: structs field by field (missing
    fields NULL), nested data to JSON text when the table holds a string,
    otherwise an ANSI-safe `try_cast` (NULL instead of an error)."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        names = {f.name: f.dataType for f in have.fields}
        parts = [
            (conform_column(col.getField(f.name), names[f.name], f.dataType) if f.name in names
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNull(), F.lit(None).cast(want)).otherwise(F.struct(*parts))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.try_cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a batch's columns to an evolved table schema; other columns untouched."""
    types = {f.name: f.dataType for f in schema.fields}
    out = []
    for f in df.schema.fields:
        want = types.get(f.name)
        c = F.col(f"`{f.name}`")
        out.append(c if want is None or want == f.dataType else conform_column(c, f.dataType, want).alias(f.name))
    return df.select(*out)
