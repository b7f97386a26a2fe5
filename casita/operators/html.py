"""Pages to listing lines (H1, S18, N31): structured data, titles, descriptions and labelled fields of HTML.

Built-in expressions take what has a fixed shape (title, meta tags, JSON-LD); the visible text needs a real parser and is
read by a pandas function over Arrow batches with the standard library's parser.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casita.functions.text import squeeze, web_text


def title(html: Column) -> Column:
    return F.nullif(web_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def meta(html: Column, name: str) -> Column:
    """The content of a meta tag by name or property."""
    a = F.regexp_extract(html, rf"""(?is)<meta[^>]+(?:name|property)\s*=\s*["']{name}["'][^>]*content\s*=\s*["']([^"']*)["']""", 1)
    b = F.regexp_extract(html, rf"""(?is)<meta[^>]+content\s*=\s*["']([^"']*)["'][^>]*(?:name|property)\s*=\s*["']{name}["']""", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def json_ld(html: Column) -> Column:
    """The JSON-LD blocks, as texts."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1)), F.trim)


class _Text(HTMLParser):
    skipped = frozenset(("script", "style", "noscript", "template", "head"))
    breaks = frozenset(("p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "ul", "ol", "table"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.depth += tag in self.skipped
        if tag in self.breaks:
            self.out.append("\n")

    def handle_endtag(self, tag: str) -> None:
        self.depth -= tag in self.skipped and self.depth > 0
        if tag in self.breaks:
            self.out.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.depth:
            self.out.append(data)


def text_of(html: str | None) -> str | None:
    """The visible text, a line a block, without empty lines."""
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return "\n".join(x for line in "".join(parser.out).split("\n") if (x := " ".join(line.split())))


@F.pandas_udf(T.StringType())
def visible_text(html: pd.Series) -> pd.Series:
    return html.map(text_of)


def _selector(text: str) -> list[tuple[str, str, frozenset[str]]]:
    """Steps of a selector such as div.price span or #main a: (tag, id, classes), outermost first; any tag where none is named."""
    steps = []
    for step in text.split():
        m = re.fullmatch(r"([\w-]*)((?:[.#][\w-]+)*)", step)
        if not m:
            raise ValueError(f"no selector {text!r}")
        marks = re.findall(r"([.#])([\w-]+)", m[2])
        steps.append((m[1].lower(), next((v for k, v in marks if k == "#"), ""), frozenset(v for k, v in marks if k == ".")))
    return steps


#: Scripts, styles and comments, which hold no references, or an ampersand that begins none that a semicolon ends.
_BARE = re.compile(r"(?is)(<!--.*?-->|<(script|style)\b.*?</\2\s*>)|&(?!(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]*);)")


def _closed(page: str) -> str:
    """page with only those references left that a semicolon ends; a parser would take &amp without one for a character too."""
    return _BARE.sub(lambda m: m[1] or "&amp;", page)


_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


class _Selected(HTMLParser):
    """The text, or an attribute, of the first element that each selector finds."""

    def __init__(self, fields: dict[str, str]) -> None:
        super().__init__(convert_charrefs=True)
        #: name: steps, attribute
        self.fields = {name: (_selector(s.split("@")[0]), s.partition("@")[2]) for name, s in fields.items()}
        self.open: list[tuple[str, str, frozenset[str]]] = []
        self.reading: dict[str, int] = {}
        self.found: dict[str, str] = {}

    def _fits(self, steps: list, element: tuple) -> bool:
        is_ = lambda want, have: want[0] in ("", have[0]) and want[1] in ("", have[1]) and want[2] <= have[2]
        if not is_(steps[-1], element):
            return False
        left = len(steps) - 2
        for outer in reversed(self.open):
            if left >= 0 and is_(steps[left], outer):
                left -= 1
        return left < 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own = dict(attrs)
        element = (tag, own.get("id") or "", frozenset((own.get("class") or "").split()))
        for name, (steps, attribute) in self.fields.items():
            if name not in self.found and self._fits(steps, element):
                self.found[name] = (own.get(attribute) or "") if attribute else ""
                if not attribute and tag not in _VOID:
                    self.reading[name] = len(self.open)
        if tag not in _VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        depth = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if depth is not None:
            del self.open[depth:]
            self.reading = {n: d for n, d in self.reading.items() if d < depth}

    def handle_data(self, data: str) -> None:
        for name in self.reading:
            self.found[name] += data


def selected(html: Column, fields: dict[str, str]) -> Column:
    """H1: a map of the fields found: by name, the text of the first element that a selector (tag, .class, #id, one inside
    the other) finds, or with @ its attribute; single spaces; fields without a text are left out. A reference without its
    semicolon, as where a page cuts a title short, stays as it is."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def find(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> dict[str, str]:
            parser = _Selected(fields)
            parser.feed(_closed(page or ""))
            parser.close()
            return {n: x for n, v in parser.found.items() if (x := " ".join(v.split()))}

        return pages.map(one)

    return find(html)


def page_line(html: Column, url: Column, fields: dict[str, str]) -> Column:
    """H1: '* location: name: value, …' of the selected fields; the location is the field of that name; the number in the
    address is the property's unless a field property_id finds one."""
    number = F.nullif(F.regexp_extract(url, r"(\d{2,})(?!.*\d)", 1), F.lit(""))

    def line(found: Column) -> Column:
        said = [(n, F.try_element_at(found, F.lit(n))) for n in fields if n not in ("location", "property_id")]
        parts = [("property_id", F.coalesce(F.try_element_at(found, F.lit("property_id")), number)), ("url", url), *said]
        shown = F.concat_ws(", ", *[F.when(v.isNotNull(), F.concat(F.lit(f"{n}: "), v)) for n, v in parts])
        return F.concat(F.lit("* "), F.coalesce(F.try_element_at(found, F.lit("location")), F.lit("Unknown location")), F.lit(": "), shown)

    return line(selected(html, fields))


def listing_line(html: Column, fields: dict[str, str]) -> Column:
    """H1: '* place: Label: value, …' from JSON-LD fields (label to JSON path), the title as the place."""
    block = F.get(json_ld(html), 0)
    parts = [F.when(F.get_json_object(block, path).isNotNull(), F.concat(F.lit(f"{label}: "), squeeze(F.get_json_object(block, path)))) for label, path in fields.items()]
    return F.concat(F.lit("* "), F.coalesce(title(html), F.lit("")), F.lit(": "), F.concat_ws(", ", *parts))


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, url, title, description, canonical, n_json_ld, text)."""
    h = F.col(html)
    return pages.select(key, F.coalesce(meta(h, "og:url"), F.col(url)).alias("url"), title(h).alias("title"), F.coalesce(meta(h, "og:description"), meta(h, "description")).alias("description"), F.size(json_ld(h)).alias("n_json_ld"), visible_text(h).alias("text"))
