"""Labels from templates: tags in braces, conditional lines, numbers, indentation."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TAG = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")
#: A tag's source: a key of the metadata, or a key and a function of its value.
Source = str | tuple[str, Callable[[object], object]]


def tags_in(template: str) -> set[str]:
    return set(TAG.findall(template))


def associate(metadata: Mapping[str, object], sources: Mapping[str, Source]) -> dict[str, object]:
    """Values of tags from metadata by the sources' rules."""
    from gridlark.functions.names import lookup

    out = {}
    for tag, s in sources.items():
        key, fn = (s, None) if isinstance(s, str) else s
        value = lookup(metadata, key)
        out[tag] = fn(value) if fn else value
    return out


def describe(product: Mapping[str, object], processors: Mapping[str, Callable[[object], object]] = {}, analyzers: Mapping[str, Callable[[Mapping[str, object]], object]] = {}) -> dict[str, object]:
    """A product's objects with processors applied to those of their names, then what analyzers find in all of them."""
    held = {k: processors[k](v) if k in processors else v for k, v in product.items()}
    return held | {k: fn(held) for k, fn in analyzers.items()}


def fill(template: str, values: Mapping[str, object]) -> str:
    """The template with its tags replaced; a tag with value None is an error, an unknown tag stays."""
    none = sorted(t for t in tags_in(template) if t in values and values[t] is None)
    if none:
        raise ValueError(f"no value for tags {', '.join(none)}")
    return TAG.sub(lambda m: str(values[m[1]]) if m[1] in values else m[0], template)


def fill_column(template: Column, values: Mapping[str, Column]) -> Column:
    """The same as a column expression."""
    out = template
    for tag, v in values.items():
        out = F.replace(out, F.lit("{" + tag + "}"), v.cast("string"))
    return out


def delete_lines(text: str, drop: Iterable[str]) -> str:
    """Without the lines from {delete:NAME} to {stop:NAME} of the named blocks, the marks of all blocks, and comment lines."""
    names, out, inside = set(drop), [], None
    for line in text.split("\n"):
        mark = re.match(r"\s*\{(delete|stop):(\w+)\}", line)
        if mark:
            if mark[1] == "delete" and mark[2] in names and inside is None:
                inside = mark[2]
            elif mark[1] == "stop" and mark[2] == inside:
                inside = None
            continue
        if inside is None and not re.match(r"\s*<!--", line):
            out.append(line)
    return "\n".join(out)


def delete_lines_frame(lines: DataFrame, drop: Iterable[str], keys: list[str]) -> DataFrame:
    """The same over a table of lines (keys, n, line), for blocks that do not overlap: the last mark before a line decides."""
    kind, name = (F.regexp_extract("line", r"^\s*\{(delete|stop):(\w+)\}", i) for i in (1, 2))
    chosen = name.isin(*drop) if list(drop) else F.lit(False)
    w = Window.partitionBy(*keys).orderBy("n")
    marked = lines.withColumns({"_kind": kind, "_on": F.when((kind != "") & chosen, kind == "delete")})
    state = F.coalesce(F.last("_on", ignorenulls=True).over(w), F.lit(False))
    return marked.withColumn("_in", state).where((F.col("_kind") == "") & ~F.col("_in") & ~F.col("line").rlike(r"^\s*<!--")).drop("_kind", "_on", "_in")


def xml_element(tag: str, value: object, **attributes: str) -> str:
    e = ET.Element(tag, attributes)
    e.text = "" if value is None else str(value)
    return ET.tostring(e, encoding="unicode")


def round_element(xml: str, tag: str, digits: int) -> str:
    """Numbers in elements of that tag, rounded."""
    return re.sub(rf"(<{tag}(?:\s[^>]*)?>)([^<]+)(</{tag}>)", lambda m: f"{m[1]}{round(float(m[2]), digits)}{m[3]}", xml)


def indent(xml: str, space: str = "  ") -> str:
    root = ET.fromstring(xml)
    ET.indent(root, space)
    return ET.tostring(root, encoding="unicode")


def _beside(first: Column, second: Column) -> Column:
    """Two maps as one; of keys that both have, the second's. map_concat refuses such keys."""
    return F.map_concat(F.map_filter(first, lambda k, v: ~F.map_contains_key(second, k)), second)


def merged_header(*headers: Column, without: Sequence[str] = ()) -> Column:
    """Maps merged, of equal keys the last one's, without the keys named and without null values."""
    held = reduce(_beside, headers)
    return F.map_filter(held, lambda k, v: v.isNotNull() & ~k.isin(*without) if without else v.isNotNull())
