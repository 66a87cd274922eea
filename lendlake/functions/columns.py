"""Cell-level cleaning rules as native expressions on one named column.

Text that is not a valid value becomes NULL, also when the session runs with ANSI
mode on: every conversion of outside data goes through ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(name: str, to: str) -> Column:
    """Typed value or NULL. Whole numbers truncate: the text ``3.7`` gives 3."""
    if to == "int":
        return F.expr(f"try_cast(try_cast({name} as double) as int)")
    return F.expr(f"try_cast({name} as {to})")


def by_rule(df: DataFrame, rules: dict[Callable[[Column], Column], list[str]]) -> DataFrame:
    """Each rule on the text of its columns, as one lambda over their array.

    So the generated code holds a rule once and not once for each column: the JVM leaves methods of more than 8,000 bytes uncompiled.
    """
    def ruled(rule: Callable[[Column], Column], names: list[str]) -> Column:
        return F.transform(F.array(*[F.col(name).cast("string") for name in names]), lambda cell: rule(cell))

    arrays = {f"_ruled_{place}": ruled(*group) for place, group in enumerate(rules.items())}
    cells = {name: F.get(array, F.lit(i)) for array, names in zip(arrays, rules.values(), strict=True) for i, name in enumerate(names)}
    return df.withColumns(arrays).withColumns(cells).drop(*arrays)


def digits_int(cell: str | Column) -> Column:
    """Keep the digits only, then read an integer (a sign is lost: ``-1`` gives 1)."""
    return F.regexp_replace(cell, "[^0-9]", "").try_cast("int")


def digits_double(cell: str | Column) -> Column:
    """Keep digits and dots, then read a double; ``1.2.3`` gives NULL."""
    return F.regexp_replace(cell, "[^0-9.]", "").try_cast("double")


def money(cell: str | Column, places: int = 3) -> Column:
    return F.round(digits_double(cell), places)


def clamp_low(name: str, low: int = 0) -> Column:
    """Raise smaller values to ``low``; NULL stays NULL."""
    return F.expr(f"if({name} < {low}, {low}, {name})")


def cap(name: str, high: int) -> Column:
    """Lower bigger values to ``high``; NULL stays NULL (``least`` would skip it)."""
    return F.expr(f"if({name} > {high}, {high}, {name})")


def within(name: str, low: int, high: int) -> Column:
    return F.expr(f"if({name} between {low} and {high}, {name}, null)")


def matching(name: str, pattern: str) -> Column:
    return F.when(F.col(name).rlike(pattern), F.col(name))


def ordinal(name: str, levels: list[str]) -> Column:
    """Position of the value in ``levels``; anything else gives NULL."""
    codes = " ".join(f"when '{level}' then {position}" for position, level in enumerate(levels))
    return F.expr(f"case {name} {codes} end")


def yes_no(name: str) -> Column:
    return F.expr(f"case {name} when 'Yes' then true when 'No' then false end")


def person_name(name: str) -> Column:
    """Letters, space, dot, apostrophe and hyphen only, without outer spaces."""
    return F.trim(F.regexp_replace(name, "[^A-Za-z .'-]", ""))


def months_from_text(name: str) -> Column:
    """``10 Years and 9 Months`` gives 129; text that starts otherwise gives NULL."""
    pattern = "^([0-9]+) Years and ([0-9]+) Months"
    years, months = (f"cast(try_cast(regexp_extract({name}, '{pattern}', {i}) as int) as bigint)" for i in (1, 2))
    return F.expr(f"try_cast({years} * 12 + {months} as int)")
