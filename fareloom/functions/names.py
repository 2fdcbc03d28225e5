"""Column-name and file-name rules."""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_FILE = r"([a-z]+_tripdata_[0-9]{4}-[0-9]{2}\.[a-z.]*[a-z])"


def snake_case(name: str) -> str:
    """A name in small letters, with an underscore before each capital from A to Z that begins a word.

    Such a capital is not the first letter, and either a small letter follows it (``PULocationID``: PU, Location)
    or a small letter or digit stands before it (Location, ID). What else stands before it does not matter: an underscore
    or a blank that is there already stays beside the new one.
    """
    spelled = ""
    for i, letter in enumerate(name):
        before, after = name[i - 1 : i], name[i + 1 : i + 2]
        if letter in ascii_uppercase and before not in ("", "\n"):
            follows = after != "" and after in ascii_lowercase
            if follows or before in ascii_lowercase or before in digits:
                spelled += "_"
        spelled += letter
    return spelled.lower()


def month_file_name(colour: str, year: int, month: int, extension: str = "parquet") -> str:
    return f"{colour}_tripdata_{year}-{month:02d}.{extension}"


def month_file_column(colour: str, moment: Column, extension: str = "parquet") -> Column:
    """The month file a trip belongs to, from its pickup time."""
    return F.concat(F.lit(f"{colour}_tripdata_"), F.date_format(moment, "yyyy-MM"), F.lit(f".{extension}"))


def month_file_of(path: Column) -> Column:
    """The month file name inside a path, whether the path is that file or a folder of parts."""
    # The same name found faster: it begins where a run of letters does, and nothing of the run is tried again.
    return F.regexp_extract(path, "(?<![a-z])" + MONTH_FILE.replace("[a-z]+", "[a-z]++"), 1)


def month_of_file(name: Column) -> Column:
    """The year and month in a month file's name, as yyyy-MM."""
    return F.regexp_extract(name, r"_([0-9]{4}-[0-9]{2})\.", 1)


def months_between(first: tuple[int, int], last: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Every (year, month) from ``first`` to ``last``, both included."""
    for ordinal in range(first[0] * 12 + first[1] - 1, last[0] * 12 + last[1]):
        yield ordinal // 12, ordinal % 12 + 1
