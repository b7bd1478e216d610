"""Text, handle, keyword and layer functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = " \t\n\x0b\f\r"


def strip(c: Column) -> Column:
    """All white space at both ends, not just blanks."""
    return F.btrim(c, F.lit(EDGE))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def filled(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)), F.lit(0)) > 0


def handle(c: Column) -> Column:
    """Trimmed, without leading @, lower case."""
    return F.lower(strip(F.regexp_replace(strip(c), r"^@+", "")))


def collectable(c: Column) -> Column:
    """Handles with a blank or a parenthesis are notes, not handles."""
    return filled(c) & ~c.rlike(r"[ ()]")


def username_from(c: Column) -> Column:
    """The handle of a profile url or of @text; empty unless letters, digits, dot and underscore only."""
    at = F.regexp_extract(c, r"@([^/?#\s]+)", 1)
    raw = handle(F.when(at != "", at).otherwise(F.regexp_extract(strip(c), r"([^/?#]*)$", 1)))
    return F.when(raw.rlike(r"^[a-z0-9._]+$"), raw).otherwise("")


def name_tokens(c: Column, drop: tuple[str, ...] = ()) -> Column:
    t = F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(t, lambda x: ~x.isin(*drop)) if drop else t


def fold(c: Column) -> Column:
    """Lower case, all but letters and digits as single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", " "))


def host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:\s]+)", 1))


def domain_slug(c: Column) -> Column:
    """The name before the public suffix; of ``x.go.com`` it is x."""
    parts = F.split(host(c), r"\.")
    n = F.size(parts)
    shared = (n >= 3) & (F.element_at(parts, -2) == "go")
    return F.when(n < 2, "").when(shared, F.get(parts, n - 3)).otherwise(F.get(parts, n - 2))


def candidates(tokens: Column, suffixes: tuple[str, ...], least: int, most: int, *first: Column) -> Column:
    """Usernames to try, in order: given ones, joined, underscored, joined with each suffix; distinct and bounded."""
    flat, lined = F.array_join(tokens, ""), F.array_join(tokens, "_")
    made = F.array(*first, lined, flat, *[F.concat(flat, F.lit(s)) for s in suffixes])
    return F.slice(F.array_distinct(F.filter(made, lambda x: x.isNotNull() & (F.length(x) >= least))), 1, most)


def split_list(c: Column, pattern: str = r"[,;/]") -> Column:
    """Parts without blanks at their ends, empty ones dropped, first of equals kept."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), pattern), handle), lambda x: x != ""))


def nlp_text(caption: Column, transcript: Column) -> Column:
    keep = lambda c: F.when(filled(c), strip(c))
    return F.concat_ws("\n---\n", keep(caption), keep(transcript))


def keyword_list(raw: Column) -> Column:
    """A JSON array, comma text or a single word as lower-case words in first-seen order."""
    listed = F.when(raw.rlike(r"^\s*\["), F.from_json(raw, "array<string>"))
    parts = F.coalesce(listed, F.split(F.coalesce(raw, F.lit("")), ","))
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.lower(strip(x))), lambda x: x.isNotNull() & (x != "")))


def merge_lists(a: Column, b: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.filter(F.array_union(F.coalesce(a, empty), F.coalesce(b, empty)), lambda x: x.isNotNull() & (x != ""))


def sticker_text(raw: Column) -> Column:
    """Names of a JSON list of stickers, blanks dropped, joined by bars."""
    names = F.from_json(raw, "array<struct<sticker_name:string>>")["sticker_name"]
    return F.array_join(F.filter(F.transform(names, strip), lambda x: x.isNotNull() & (x != "")), " | ")


def visual_text(c: Column) -> Column:
    """Lower-case lines, rules as line breaks, single blanks, no empty lines at the ends."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"\n?-{3,}\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.lower(F.regexp_replace(t, r"^[ \n]+|[ \n]+$", ""))


def text_lines(c: Column) -> Column:
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?|\n?---\n?", "\n"), "\n")
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def line_key(x: Column) -> Column:
    return F.lower(squeeze(x))


def merge_layers(df: DataFrame, key: str, *layers: tuple[str, Column]) -> DataFrame:
    """One row per key: ``lines``, array of (place, layer, line) of the layers in order, the first of equal lines kept.

    Equal lines meet in a partial aggregate, so the work is linear in the number of lines.
    """
    tagged = F.concat(*[F.transform(text_lines(c), lambda x, n=name: F.struct(F.lit(n).alias("layer"), x.alias("line"))) for name, c in layers])
    each = df.select(key, F.posexplode_outer(tagged).alias("place", "x"))
    first = each.groupBy(key, line_key(F.col("x.line")).alias("k")).agg(F.min(F.struct("place", "x.layer", "x.line")).alias("x"))
    return first.groupBy(key).agg(F.sort_array(F.filter(F.collect_list("x"), lambda x: x["place"].isNotNull())).alias("lines"))


def jaccard(a: Column, b: Column, both_empty: float) -> Column:
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(both_empty)).otherwise(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), either))


def word_set(c: Column, stop: tuple[str, ...] = ()) -> Column:
    t = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]{2,}"), F.lit(0)))
    return F.filter(t, lambda x: ~x.isin(*stop)) if stop else t


def alpha_ratio(c: Column) -> Column:
    """Share of letters of any script, 0 for no text."""
    n = F.length(c)
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(c, r"\P{L}+", "")).cast("double"), n), F.lit(0.0))


def api_error_code(message: Column) -> Column:
    m = F.lower(F.coalesce(message, F.lit("")))
    return F.when(m == "", "").when(m.contains("429") | m.contains("rate limit"), "rate_limited").when(m.contains("401") | m.contains("unauthor"), "unauthorized").when(m.contains("timeout") | m.contains("timed out"), "timeout").when(m.rlike(r"\b5\d\d\b"), "server_error").otherwise("http_error")


def error_type(message: Column) -> Column:
    return F.substr(F.substring_index(F.coalesce(message, F.lit("")), ":", 1), F.lit(1), F.lit(80))


def unfenced_json(c: Column) -> Column:
    """A label response without its code fence."""
    return strip(F.regexp_replace(strip(c), r"^```[a-z]*\s*|\s*```$", ""))


def webvtt_text(c: Column) -> Column:
    """Caption lines without header, notes, cue numbers and timings; repeats of the line before go."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\r?\n"), strip), lambda x: (x != "") & ~x.rlike(r"^(WEBVTT|NOTE)|-->|^\d+$"))
    return F.array_join(F.filter(lines, lambda x, i: (i == 0) | (F.get(lines, i - 1) != x)), " ")


def json_search(df: DataFrame, key: str, raw: str, word: str) -> DataFrame:
    """(key, path, match): where a JSON text of any depth has the word in a key or in a text value."""
    import json

    import pyarrow as pa

    def walk(node, at):
        pairs = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ()
        for name, child in pairs:
            here = f"{at}.{name}" if isinstance(node, dict) else f"{at}[{name}]"
            if isinstance(node, dict) and word in name:
                yield here, "key"
            if isinstance(child, str) and word in child:
                yield here, "value"
            yield from walk(child, here)

    def rows(batches):
        for b in batches:
            out = []
            for k, text in zip(b.column(key).to_pylist(), b.column(raw).to_pylist(), strict=True):
                try:
                    out += [(k, *hit) for hit in walk(json.loads(text or "null"), "$")]
                except ValueError:
                    continue  # a broken text holds nothing
            yield pa.record_batch([pa.array([x[0] for x in out], b.schema.field(key).type), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.string())], names=[key, "path", "match"])

    return df.select(key, raw).mapInArrow(rows, f"{key} {dict(df.dtypes)[key]}, path string, match string")
