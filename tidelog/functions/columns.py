"""Column expressions shared by the operators.  All of them stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# valid_to of a version nobody has closed yet (one typed constant), and the start of the unknown member
END_OF_TIME = "timestamp_ntz'9999-12-31 23:59:59'"
START_OF_TIME = "timestamp_ntz'1970-01-01 00:00:00'"


def end_of_time() -> Column:
    return F.expr(END_OF_TIME)


def start_of_time() -> Column:
    return F.expr(START_OF_TIME)


def epoch_seconds(at: str) -> str:
    """SQL for the seconds since 1970 of a zone-less timestamp, without going through a session zone."""
    return (
        f"(datediff(to_date({at}), date'1970-01-01') * 86400L"
        f" + hour({at}) * 3600 + minute({at}) * 60 + second({at}))"
    )


def epoch_micros(at: str) -> str:
    """SQL for the microseconds since 1970 of a zone-less timestamp; never decreases with it."""
    return f"({epoch_seconds(at)} * 1000000L + bigint((extract(second from {at}) - second({at})) * 1000000))"


def seconds_between(start: str, end: str) -> Column:
    """Duration in seconds, with microseconds kept."""
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end}) / 1e6D")


def date_key(at: str) -> Column:
    """yyyyMMdd as an integer."""
    return F.expr(f"year({at}) * 10000 + month({at}) * 100 + day({at})")


def cleaned(text: str) -> Column:
    return F.expr(f"trim(coalesce({text}, ''))")


def masked_last_name(name: str) -> Column:
    """First letter and a dot."""
    return F.expr(f"substring({name}, 1, 1) || '.'")


def masked_email(email: str) -> Column:
    """Two leading characters, stars, then everything from the first at-sign on."""
    return F.expr(
        f"if(contains({email}, '@'), substring({email}, 1, 2) || '***@' || regexp_replace({email}, '^[^@]*@', ''), '***')"
    )


def instant_text(at: str) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sequence_key(key: str, seq: str) -> Column:
    return F.concat(F.col(key), F.lit("_"), F.col(seq).cast("string"))


def second_key(key: str, at: str) -> Column:
    return F.concat(F.col(key), F.lit("_"), F.date_format(at, "yyyyMMddHHmmss"))


def digest_key(key: str, at: str) -> Column:
    return F.md5(F.concat(F.col(key), F.lit("_"), instant_text(at)))


#: Amounts of this size and above are no money: a sum of them could not be kept exact.
MONEY_BELOW = 1e15


def is_money(amount: Column) -> Column:
    """Whether a number is finite and small enough for ``money``; NULL for NULL."""
    return (amount > -MONEY_BELOW) & (amount < MONEY_BELOW)  # NaN is above every number


def money(amount: str | Column) -> Column:
    """Exact sum of an amount column: it does not depend on the order of rows, and only the sum is rounded."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(amount.cast("decimal(28,10)"))


def as_double(exact: str | Column) -> Column:
    exact = F.col(exact) if isinstance(exact, str) else exact
    return exact.cast("double")
