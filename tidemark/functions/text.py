"""Text expressions: tokens, log fields, labels and formatted lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The access-log line layout, word separators and token separators.
ACCESS_LOG = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
ACCESS_TIME = "dd/MMM/yyyy:HH:mm:ss"
WORD_SEPARATORS = r"[\p{Punct}\s]+"
TOKEN_SEPARATORS = r"[^\p{L}\p{N}_]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: str | Column) -> Column:
    """Lower-case words between ASCII punctuation and spaces; empty strings remain."""
    return F.split(F.lower(col(text)), WORD_SEPARATORS)


def tokens(text: str | Column) -> Column:
    """Distinct lower-case letter/digit tokens, empty ones dropped."""
    return F.array_remove(F.array_distinct(F.split(F.lower(col(text)), TOKEN_SEPARATORS)), "")


def concat_fields(fields: Sequence[str]) -> Column:
    """Join columns by a space; a null field counts as empty text."""
    return F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])


def extract_groups(text: str | Column, pattern: str, names: Sequence[str]) -> list[Column]:
    """The capture groups of ``pattern`` as named columns."""
    return [F.regexp_extract(col(text), pattern, i).alias(n) for i, n in enumerate(names, 1)]


def parse_log_time(text: str | Column) -> Column:
    """Log time without its zone offset; unreadable text gives null."""
    return F.try_to_timestamp(col(text), F.lit(ACCESS_TIME)).cast("timestamp_ntz")


def hour_label(path: str | Column) -> Column:
    """``yyyymmdd-HHMM`` from a path such as ``.../pagecounts-20160801-120000.gz``."""
    return F.regexp_extract(col(path), r"pagecounts-(\d{8}-\d{4})", 1)


def join_sorted(values: str | Column) -> Column:
    return F.array_join(F.array_sort(col(values)), ", ")


def order_line(key: str | Column, price: str | Column, names: str | Column) -> Column:
    return F.format_string("Order #%d $%.2f: %s", col(key), col(price), col(names))


def min_number(text: str | Column, digits: str = r"\d+") -> Column:
    """Smallest of the whole numbers in a text, compared as numbers; null when there is none."""
    found = F.regexp_extract_all(col(text), F.lit(f"({digits})"), F.lit(1))
    return F.array_min(F.transform(found, lambda d: d.try_cast("bigint")))


def smallest_year(text: str | Column, lo: int, hi: int) -> Column:
    """Smallest digit run of four digits within a range, null when there is none."""
    runs = F.filter(F.regexp_extract_all(col(text), F.lit(r"(\d+)"), F.lit(1)), lambda d: F.length(d) == 4)
    years = F.transform(runs, lambda d: d.try_cast("int"))
    return F.array_min(F.filter(years, lambda y: y.between(lo, hi)))


def clean_text(text: str | Column) -> Column:
    """Collapse white space, trim, title case."""
    return F.initcap(F.trim(F.regexp_replace(col(text), r"\s+", " ")))


def list_item(text: str | Column, separator: str, position: int) -> Column:
    """Trimmed one-based part of a separated text; null when there are too few parts."""
    return F.trim(F.try_element_at(F.split(col(text), separator), F.lit(position)))


def absolutise(link: str | Column, page: str | Column) -> Column:
    """Address that a link means on a page: links with a scheme are kept, ``//host``, ``/path``, ``?query``,
    ``#part`` and relative paths with dot segments are resolved. Without an address of the page the link stays."""
    href, base = F.trim(col(link)), col(page)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    own, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))

    def walk(done: Column, step: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(step == "..", up).when(step == ".", done).otherwise(F.array_append(done, step))

    steps = F.aggregate(F.split(F.substring(full, 2, 1 << 30), "/"), F.array().cast("array<string>"), walk)
    ends = F.when(full.rlike(r"/\.\.?$") & (F.size(steps) > 0), "/").otherwise("")
    return (
        F.when((origin == "") | base.isNull() | href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]*:)", 1), href))
        .when(href == "", F.regexp_replace(base, "#.*$", ""))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(origin, F.when(path == "", "/").otherwise(path), href))
        .otherwise(F.concat(origin, F.lit("/"), F.array_join(steps, "/"), ends, rest))
    )


def parse_list(text: str | Column) -> Column:
    """``[a, b, c]`` as an array of trimmed strings."""
    inner = F.trim(F.btrim(F.trim(col(text)), F.lit("[]")))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"\s*,\s*"))
