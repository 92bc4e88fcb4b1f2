"""Categories as numbers and as indicator features.

A ``CategoryIndex`` numbers the values of a column: the most frequent one is 0, equal counts go by
value. Two places follow the categories: one for values that the fit has not seen, one for null. The
index is a table that is joined, so a column may have any number of values.

A ``Layout`` puts numeric columns and indexed ones into one sparse vector: first the numbers, in the
order named, then a block per category column with a place per category, one for unseen values and one
for null. The same ranks hold in the library's own ``entries`` and in the vectors of ``pyspark.ml``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.operators.joins import left_small, measure
from brambling.operators.tables import ranked
from brambling.session import cut


def free_name(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


@dataclass(frozen=True)
class CategoryIndex:
    """``table (value, place, cnt)`` with one row per category, its number of rows and its bytes."""

    table: DataFrame
    size: int
    nbytes: int

    @property
    def unseen(self) -> int:
        return self.size

    @property
    def missing(self) -> int:
        return self.size + 1

    @property
    def places(self) -> int:
        """Categories, and the places for unseen values and null."""
        return self.size + 2

    def place_of(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """``df`` with the place of each value; all rows stay."""
        value, place = free_name("_value", df), free_name("_place", df)
        known = self.table.select(F.col("value").alias(value), F.col("place").alias(place))
        joined = left_small(df, known, F.col(column) == F.col(value), self.nbytes)
        found = F.when(F.col(column).isNull(), self.missing).otherwise(F.coalesce(place, F.lit(self.unseen)))
        return joined.select(*df.columns, found.alias(name))

    def value_of(self, df: DataFrame, place: str, name: str) -> DataFrame:
        """``df`` with the value at each place; null for the two last places and for no place."""
        value, own = free_name("_value", df), free_name("_place", df)
        known = self.table.select(F.col("value").alias(value), F.col("place").alias(own))
        joined = left_small(df, known, F.col(place) == F.col(own), self.nbytes)
        return joined.select(*df.columns, F.col(value).alias(name))


def fit_index(df: DataFrame, column: str, least: int = 1) -> CategoryIndex:
    """Categories are the values with ``least`` rows or more; null is none."""
    counts = df.select(F.col(column).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("cnt"))
    numbered = ranked(counts.where(F.col("cnt") >= least), [F.desc("cnt"), F.asc("value")], "place")
    table = cut(numbered.select("value", F.col("place").cast("int").alias("place"), "cnt"))
    return CategoryIndex(table, *measure(table))


@dataclass(frozen=True)
class Layout:
    """Which rank of a vector has which meaning.

    ``drop_last`` leaves out the last place of each block, that of null, so that the places of a
    block are not linearly dependent; such rows have no entry in the block.
    """

    numeric: tuple[str, ...] = ()
    categorical: dict[str, CategoryIndex] = field(default_factory=dict)
    drop_last: bool = False

    def width(self, column: str) -> int:
        return self.categorical[column].places - int(self.drop_last)

    def begins(self) -> dict[str, int]:
        """The first rank of each block."""
        out, at = {}, len(self.numeric)
        for column in self.categorical:
            out[column], at = at, at + self.width(column)
        return out

    @property
    def size(self) -> int:
        return len(self.numeric) + sum(map(self.width, self.categorical))

    def places(self, df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """``df`` with a place column per category column, and the names of these."""
        names = {}
        for column, index in self.categorical.items():
            names[column] = free_name(f"_place_of_{column}", df)
            df = index.place_of(df, column, names[column])
        return df, names

    def entries(self, df: DataFrame, name: str = "entries") -> DataFrame:
        """``df`` with ``array<struct<rank, value>>`` by rank; zeros, nulls and NaN have no entry."""
        wide, names = self.places(df)
        cells = [F.struct(F.lit(k).alias("rank"), F.col(c).cast("double").alias("value")) for k, c in enumerate(self.numeric)]
        for column, begin in self.begins().items():
            place = F.col(names[column])
            value = F.when(place < self.width(column), 1.0).otherwise(0.0)
            cells.append(F.struct((place + begin).cast("int").alias("rank"), value.alias("value")))
        every = F.array(*cells) if cells else F.array().cast("array<struct<rank:int,value:double>>")
        held = F.filter(every, lambda e: e["value"].isNotNull() & ~F.isnan(e["value"]) & (e["value"] != 0))
        return wide.select(*df.columns, held.alias(name))

    def vectors(self, df: DataFrame, name: str = "features") -> DataFrame:
        """``df`` with a vector column for ``pyspark.ml``; nulls and NaN count as 0."""
        wide, names = self.places(df)
        numbers = [free_name(f"_number_{k}", wide) for k in range(len(self.numeric))]
        wide = wide.withColumns({n: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for n, c in zip(numbers, self.numeric)})
        blocks = [f"{n}_vector" for n in names.values()]
        if names:
            # The width of a block is known, so the encoder is fitted on the last places alone.
            last = df.sparkSession.range(1).select(*(F.lit(float(self.categorical[c].missing)).alias(n) for c, n in names.items()))
            encoder = OneHotEncoder(inputCols=list(names.values()), outputCols=blocks, dropLast=self.drop_last).fit(last)
            wide = encoder.transform(wide)
        return VectorAssembler(inputCols=numbers + blocks, outputCol=name).transform(wide).select(*df.columns, name)

    def describe(self, df: DataFrame) -> DataFrame:
        """``(rank, column, value)``: the meaning of each rank; the value as text, null for numbers.

        The places of unseen values and null are named ``(unseen)`` and ``(null)``.
        """
        numbers = [(k, c, None) for k, c in enumerate(self.numeric)]
        table = df.sparkSession.createDataFrame(numbers, "rank int, column string, value string")
        for column, begin in self.begins().items():
            index = self.categorical[column]
            own = index.table.select((F.col("place") + begin).alias("rank"), F.lit(column).alias("column"), F.col("value").cast("string").alias("value"))
            rest = [(begin + index.unseen, column, "(unseen)"), (begin + index.missing, column, "(null)")][: 1 if self.drop_last else 2]
            table = table.unionByName(own).unionByName(df.sparkSession.createDataFrame(rest, table.schema))
        return table


def fit_layout(df: DataFrame, numeric: tuple[str, ...] = (), categorical: tuple[str, ...] = (), drop_last: bool = False, least: int = 1) -> Layout:
    return Layout(tuple(numeric), {c: fit_index(df, c, least) for c in categorical}, drop_last)
