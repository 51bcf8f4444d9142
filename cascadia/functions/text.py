"""Text expressions: paths, flags, URL coding, signatures, stable suffixes."""

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def dirname(path: Column) -> Column:
    """Directory part of a path; empty for a bare file name."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def leaf(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def relative_to(path: Column, root: Column) -> Column:
    """``path`` below ``root``; the root itself is ``.`` and other paths stay as they are."""
    return (
        F.when(path == root, F.lit("."))
        .when(path.startswith(F.concat(root, F.lit("/"))), F.substr(path, F.length(root) + 2))
        .otherwise(path)
    )


def csv_list(text: Column) -> Column:
    """Comma list to array, where the empty text is the empty array."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ",", -1))


def brace_list(text: Column) -> Column:
    """Array literal text ``{a,b}`` to array."""
    inner = F.regexp_replace(F.regexp_replace(text, r"^\{", ""), r"\}$", "")
    return csv_list(inner)


def empty_list() -> Column:
    return F.array().cast("array<string>")


def stable_hash(*parts: Column) -> Column:
    """Text hash of the parts: the same on every attempt, unlike a random number."""
    return F.md5(F.concat_ws("|", *parts))


def stable_number(*parts: Column) -> Column:
    """Non-negative integer below 2**32 from the hash of the parts."""
    return F.conv(F.substring(stable_hash(*parts), 1, 8), 16, 10).cast("bigint")


def target_flags(resources: Column) -> Column:
    """`` -target r1 -target r2``; the empty array gives the empty text."""
    return F.array_join(F.transform(resources, lambda r: F.concat(F.lit(" -target "), r)), "")


def _quote_plus(text: Column) -> Column:
    # Form encoding that also escapes "*" and leaves "~".
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def link_encode(text: Column) -> Column:
    """Form encoding applied twice, blanks kept single-coded, ``%`` written as ``$``."""
    once = F.replace(_quote_plus(text), F.lit("+"), F.lit(" "))
    return F.replace(_quote_plus(once), F.lit("%"), F.lit("$"))


def link_decode(text: Column) -> Column:
    """Inverse of :func:`link_encode`; text that is not a valid code gives NULL."""
    once = F.try_url_decode(F.replace(text, F.lit("$"), F.lit("%")))
    return F.try_url_decode(F.regexp_replace(once, r"(?U)\s", "+"))


def hmac_sha256(secret: str, message: Column) -> Column:
    """Hex HMAC-SHA256 of ``message`` under a job parameter."""
    key = secret.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner_pad = F.unhex(F.lit(bytes(b ^ 0x36 for b in key).hex()))
    outer_pad = F.unhex(F.lit(bytes(b ^ 0x5C for b in key).hex()))
    inner = F.sha2(F.concat(inner_pad, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)
