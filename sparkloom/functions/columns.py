"""Native column expressions; all stay inside the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import COMPANIES, COMPANY_IDS

#: What Python's ``\s`` matches, in Java's notation.
WS = r"[\s\x1c-\x1f\x85\p{Z}]+"
# The characters that the clean-up filters remove or keep.
URL = r"https?://[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;%=]+" + WS[:-1] + "*"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+"
NOT_KEPT = r"[^\x{4e00}-\x{9fff}.~<、,。《?>*\-!》:」「+%/a-zA-Z\p{Nd}()\[\]【】]"
BRACKETS = {"paren": "()", "bracket": "[]", "curly": "{}", "lenticular": "【】"}


def collapse_ws(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, WS, " "))


def strip_pattern(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, pattern, by)


def strip_urls(text: Column) -> Column:
    return strip_pattern(text, URL)


def strip_emoji(text: Column) -> Column:
    return strip_pattern(text, EMOJI)


def strip_non_cjk(text: Column) -> Column:
    """Only CJK ideographs, Latin letters, digits and the listed marks stay; spaces go too."""
    return strip_pattern(text, NOT_KEPT)


def strip_flat_brackets(text: Column, kind: str) -> Column:
    """Bracketed stretches without brackets inside go; for nested ones see ``arrow.strip_delimited``."""
    a, b = (re.escape(x) for x in BRACKETS[kind])
    return strip_pattern(text, f"{a}[^{a}{b}]*{b}")


def check_bounds(least: int, most: int) -> None:
    if least < 0 or most < -1:
        raise ValueError("bounds must not be negative, but for -1 as the upper one")


def length_between(text: Column, least: int = 0, most: int = -1) -> Column:
    """Code points from ``least`` to ``most``, both included; -1 is no upper bound."""
    check_bounds(least, most)
    kept = F.length(text) >= least
    return kept if most == -1 else kept & (F.length(text) <= most)


def company_id(name: Column) -> Column:
    """The id of a source's name; an unknown name is an error."""
    table = F.create_map(*[F.lit(x) for pair in COMPANY_IDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.raise_error(F.concat(F.lit("unknown company: "), F.coalesce(name, F.lit("null")))).cast("int"))


def company_url(company: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(u) for _, _, u, _ in COMPANIES]), company.cast("int") + 1)


def compress_url(company: Column, url: Column) -> Column:
    """The captured parts of an address joined by dashes; an address that doesn't match stays."""
    out = F.lit(None).cast("string")
    for i, (_, _, _, pattern) in enumerate(COMPANIES):
        anchored = "^" + pattern.replace(r"\w", r"[\w\p{L}\p{N}]")
        parts = F.concat_ws("-", *[F.regexp_extract(url, anchored, g) for g in range(1, re.compile(pattern).groups + 1)])
        out = F.when(company == i, F.when(url.rlike(anchored), parts).otherwise(url)).otherwise(out)
    return out


def epoch_text(seconds: Column) -> Column:
    """``YYYY-mm-dd HH:MM:SS+0000``; the session's time zone must be UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ssxx")


def card(timestamp: Column, **fields: Column) -> Column:
    """A record as a boxed text: title line, then a field a line; null and empty fields show as None."""
    shown = {"datetime": epoch_text(timestamp), **{k: F.when(F.coalesce(v, F.lit("")) == "", F.lit("None")).otherwise(v.cast("string")) for k, v in fields.items()}}
    width = reduce(F.greatest, [F.length(v) for v in shown.values()]) if len(shown) > 1 else F.length(shown["datetime"])
    lines = [F.concat(F.lit("| "), F.rpad(F.lit(k), 12, " "), F.lit("| "), F.rpad(v, width, " "), F.lit(" |")) for k, v in shown.items()]
    rule = F.concat(F.lit("+" + "-" * 13 + "+"), F.repeat(F.lit("-"), width + 2), F.lit("+"))
    return F.concat_ws("\n", rule, *lines, rule)


def url_date(url: Column, source: str) -> Column:
    """The date in an address of epochtimes (a one-digit year is 200y, else 20yy) or ntdtv; null without one."""
    if source == "epochtimes":
        at = r"^https://www\.epochtimes\.com/b5/(\d+)/(\d+)/(\d+)/n\d+\.htm"
        year = F.lpad(F.regexp_extract(url, at, 1), 2, "0")
        year = F.concat(F.lit("20"), year)
    elif source == "ntdtv":
        at = r"^https://www\.ntdtv\.com/b5/(\d+)/(\d+)/(\d+)/a\d+\.html"
        year = F.regexp_extract(url, at, 1)
    else:
        raise ValueError(f"no dates in addresses of {source}")
    parts = F.concat_ws("-", year, F.lpad(F.regexp_extract(url, at, 2), 2, "0"), F.lpad(F.regexp_extract(url, at, 3), 2, "0"))
    return F.when(url.rlike(at), F.try_to_timestamp(parts, F.lit("yyyy-MM-dd"))).cast("date")


def local_epoch(text: Column, pattern: str, zone: str = "Asia/Taipei", shift_hours: int = 0) -> Column:
    """Epoch seconds of a local time, ``shift_hours`` before what it says; null where it can't be read."""
    stamp = F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(pattern)), zone)
    return F.unix_timestamp(stamp) - 3600 * shift_hours


def ordered_distinct_join(parts: Column) -> Column:
    """Distinct parts by first occurrence, joined by commas."""
    return F.concat_ws(",", F.array_distinct(parts))


def json_field(text: Column, name: str) -> Column:
    """A member of a JSON object, as text; null where there is none or the text is no object."""
    return F.get_json_object(text, f"$['{name}']")


def status_class(status: Column) -> Column:
    """What a fetch came to, by its HTTP status."""
    return (
        F.when(status == 200, "ok").when(status == 403, "banned").when(status.isin(404, 410), "not found").when(status == 429, "too many requests").otherwise("weird status")
    )


def end_sentence(text: Column) -> Column:
    """A full stop for a text that has none at its end; empty texts stay empty."""
    return F.when((text != "") & ~text.rlike("[。!?]$"), F.concat(text, F.lit("。"))).otherwise(text)


def native_clean(text: Column, steps: list[str]) -> Column:
    """Clean-up steps in their fixed order, all native."""
    known = {"url": strip_urls, **{k: (lambda c, k=k: strip_flat_brackets(c, k)) for k in BRACKETS}, "emoji": strip_emoji, "non_cjk": strip_non_cjk}
    if unknown := set(steps) - set(known):
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    for name, step in known.items():
        if name in steps:
            text = step(text)
    return text
