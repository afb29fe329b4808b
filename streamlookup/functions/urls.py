"""URL to host, as column expressions that stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The schemes accepted in lenient mode. Anything else counts as
# an invalid URL, as does text without a scheme.
SCHEMES = ("http", "https", "ftp", "file", "mailto")

# Characters removed from both ends before parsing: blank and control characters.
_BLANKS = "".join(chr(c) for c in range(33))

# The patterns are possessive: a URL is scanned once, without going back.
_SCHEME = rf"(?i:url:)?+(?i:{'|'.join(SCHEMES)}):"
_USER = r"(?:[^/?#@]*+@)?+"
_PORT = r"(?::\d*+)?+"
_IPV6 = r"\[[0-9A-Fa-f:.]++(?:%[^\]/?#]*+)?+\]"

# Nearly all URLs: a host without blanks. No match, and no host, is left to the
# full pattern, which needs the text trimmed.
_PLAIN = (
    rf"^[\x00-\x20]*+{_SCHEME}//{_USER}({_IPV6}|[^\[/?#:@\x00-\x20][^/?#:@\x00-\x20]*+){_PORT}"
    r"(?=[/?#]|[\x00-\x20]*+\z)"
)

# After '//' either [user-info@]host[:port], or text with several '@' (then the
# host is empty); a URL without '//' has an empty host as well.
_FULL = (
    rf"^{_SCHEME}(?://(?:{_USER}({_IPV6}|[^\[/?#:@][^/?#:@]*+|){_PORT}(?=[/?#]|\z)"
    r"|[^/?#@]*+@[^/?#@]*+@[^/?#]*+)|(?!//))"
)

MODES = ("lenient", "strict")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _lenient_host(url: Column) -> Column:
    trimmed = F.btrim(url, F.lit(_BLANKS))
    rare = F.when(trimmed.rlike(_FULL), F.regexp_extract(trimmed, _FULL, 1))
    # nullif evaluates its argument once, unlike a comparison with ''.
    return F.coalesce(F.nullif(F.regexp_extract(url, _PLAIN, 1), F.lit("")), rare)


def url_host(url: Column | str, mode: str = "lenient", on_invalid: str = "fail") -> Column:
    """Host of a URL, verbatim: case and ``www.`` kept, port and user-info removed.

    ``lenient`` takes any characters in the host and gives an empty host for a
    URL without one. ``strict`` is Spark's RFC parser, which knows no host in
    either case. ``on_invalid`` is ``fail`` (the job fails with the offending
    text) or ``null``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    url = _column(url)
    host = _lenient_host(url) if mode == "lenient" else F.try_parse_url(url, F.lit("HOST"))
    if on_invalid == "null":
        return host
    if on_invalid == "fail":
        message = F.concat(F.lit("invalid URL: "), F.coalesce(url, F.lit("NULL")))
        # The last, never reached value makes the host non-nullable: a join on it
        # needs no null filter, which would work out the host a second time.
        return F.coalesce(host, F.raise_error(message).cast("string"), F.lit(""))
    raise ValueError(f"on_invalid must be 'fail' or 'null', got {on_invalid!r}")


def with_host(messages: DataFrame, into: str = "host", url: str = "url", mode: str = "lenient") -> DataFrame:
    """The messages whose URL is valid, with its host.

    A generator with an output or none. A filter would be moved below the
    projection and work out the host again.
    """
    host = url_host(url, mode, "null")
    return messages.select("*", F.explode(F.array_compact(F.array(host))).alias(into))


def invalid_urls(messages: DataFrame, url: str = "url", mode: str = "lenient") -> DataFrame:
    """The messages whose URL has no host to look up, for a dead-letter sink."""
    return messages.where(url_host(url, mode, "null").isNull())
