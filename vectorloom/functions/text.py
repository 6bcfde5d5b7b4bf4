"""Column expressions for text; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.strip() removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Model URI schemes and the type each one stands for.
MODEL_SCHEMES = {"openai": "openai", "hf": "huggingface", "gguf": "llamacpp"}

WORD_BREAK = r"[^\p{L}\p{N}]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    # btrim walks each end once; an anchored \s+$ pattern rescans every inner blank run
    return F.btrim(_col(text), F.lit(STRIP_CHARS))


def raw_text_hash(text: Column | str) -> Column:
    return F.sha2(_col(text), 256)


def normalised_text_hash(text: Column | str) -> Column:
    return F.sha2(F.lower(strip(text)), 256)


def affix(text: Column | str, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), _col(text), F.lit(suffix))


def ellipsis(text: Column | str, width: int) -> Column:
    text = _col(text)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def token_estimate(text: Column | str) -> Column:
    return F.floor(F.length(_col(text)) / 4)


def model_type(uri: Column | str) -> Column:
    uri = _col(uri)
    kind = F.lit("unknown")
    for scheme, name in MODEL_SCHEMES.items():
        kind = F.when(uri.startswith(f"{scheme}://"), name).otherwise(kind)
    return kind


def model_name(uri: Column | str) -> Column:
    """What follows the scheme; without a scheme the URI is the name."""
    uri = _col(uri)
    at = F.instr(uri, "://")
    return F.when(at > 0, F.substring(uri, at + 3, F.length(uri))).otherwise(uri)


def model_safe_name(model: Column | str) -> Column:
    return F.translate(_col(model), "/:", "__")


def model_short_name(model: Column | str) -> Column:
    return F.substring_index(_col(model), "/", -1)


def words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(_col(text)), WORD_BREAK), "")


def non_blank_lines(text: Column | str) -> Column:
    """Stripped lines of a multi-line text, blank ones left out."""
    stripped = F.transform(F.split(_col(text), "\n"), lambda line: F.btrim(line, F.lit(STRIP_CHARS)))
    return F.array_remove(stripped, "")
