"""Lines to listings (G1 to G11, G13 to G16, G18, G19, X15): marks on lines, then blocks by a running count of starts within a file.

Every segmenter marks headers and starts with built-in expressions; one window over a file's lines numbers the blocks and
one aggregate joins them. A file is one issue, so its lines fit a task; files spread over the cluster. Order is carried
by line_no throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casita.functions.listing import BATH_WORDS, BED_WORDS, strip_bullet
from casita.functions.text import let, squeeze

HEADER = r"^\s*#"


def lines_of(files: DataFrame) -> DataFrame:
    """files (file, value) to (file, line_no, line), line_no from 0."""
    return files.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r\n?", "\n"), "\n", -1)).alias("line_no", "line"))


def _by_file() -> Window:
    return Window.partitionBy("file").orderBy("line_no")


def literal_start(line: Column, marker: str = "*") -> Column:
    """G1: the marker and white space."""
    import re

    return line.rlike(rf"^\s*{re.escape(marker)}\s+")


def numbered_start(line: Column) -> Column:
    """12. or 12) before a letter."""
    return line.rlike(r"(?u)^\s*\d{1,3}[.)]\s*\p{L}")


def cue_start(line: Column, cue: str = ":", max_position: int = 32) -> Column:
    """The cue stands early, after a letter, and the line does not start with an amount."""
    at = F.instr(line, cue)
    return (at > 0) & (at <= max_position + 1) & F.substring(line, F.lit(1), at - 1).rlike(r"(?u)\p{L}") & ~line.rlike(r"(?i)^\s*(?:US\$|\$|LPS?\.?|USD|\d)")


def comma_or_dot_start(line: Column, max_position: int = 32) -> Column:
    """An early comma or dot that is no decimal, after letters, with a price or a capital soon after it."""
    comma = line.rlike(rf"(?u)^(?=[^,]*\p{{L}})[^,]{{1,{max_position}}},(?!\d)[\s\S]{{0,40}}(?:US\$|\$|LPS?\.?\s*)\s*\d")
    dot = line.rlike(rf"(?u)^(?!\s*(?i:col|res|urb|bo|ave?|blvd|no)\.)(?=[^.]*\p{{L}})[^.]{{1,{max_position}}}\.(?!\d)\s*(?:\p{{Lu}}|US\$|\$|LPS?\.)")
    return comma | dot


def _chunk(line: Column) -> Column:
    return F.trim(F.regexp_extract(strip_bullet(line), r"^([^.,:;]*)", 1))


def uppercase_candidate(line: Column, exceptions: tuple[str, ...] = ()) -> Column:
    """What stands before . , : ; has an upper-case letter and no lower-case one."""
    c = _chunk(line)
    ok = c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}") & ~line.rlike(HEADER)
    return ok & ~F.upper(squeeze(c)).isin(*[e.upper() for e in exceptions]) if exceptions else ok


def with_uppercase_starts(lines: DataFrame, exceptions: tuple[str, ...] = ()) -> DataFrame:
    """Lines with `start`. A title without an end mark goes on in a following title; that one starts nothing, and by
    itself takes nothing with it, so in a chain of open titles every second line is a continuation."""
    w = _by_file()
    rows = lines.withColumn("__up", uppercase_candidate(F.col("line"), exceptions)).withColumn("__open", F.col("__up") & ~strip_bullet(F.col("line")).rlike("[.,:;]"))
    rows = rows.withColumn("__joined", F.col("__up") & F.coalesce(F.lag("__open").over(w), F.lit(False)))
    rows = rows.withColumn("__chain", F.sum(F.when(F.col("__joined"), 0).otherwise(1)).over(w))
    place = F.row_number().over(Window.partitionBy("file", "__chain").orderBy("line_no"))
    return rows.withColumn("start", F.col("__up") & ~(F.col("__joined") & (place % 2 == 0))).drop("__up", "__open", "__joined", "__chain")


def freeform_score(line: Column, prefixes: tuple[str, ...] = ()) -> Column:
    """Price 2; area, beds, baths, phone, a place prefix, an upper-case heading and a capital start 1 each."""
    point = lambda hit, n=1: F.when(hit, n).otherwise(0)
    score = point(line.rlike(r"(?i)(?:US\$|\$|LPS?\.?|USD|HNL)\s*\d"), 2) + point(line.rlike(r"(?iu)\d\s*(?:m2|m²|mts?2?|vrs?2?|vrs²|varas?)(?![\w])"))
    score += point(line.rlike(rf"(?iu)\d\s*{BED_WORDS}")) + point(line.rlike(rf"(?iu)\d\s*{BATH_WORDS}")) + point(line.rlike(r"\b\d{4}[- ]\d{4}\b"))
    for p in prefixes[:1] and [prefixes]:
        hit = F.lit(False)
        for word in p:
            hit = hit | F.contains(F.lower(line), F.lit(word.lower()))
        score += point(hit)
    return score + point(F.trim(line).rlike(r"^[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ\s.]{3,}$")) + point(line.rlike(r"^\s*[A-ZÁÉÍÓÚÜÑ]"))


# Cues by name.
CUES = {"CUE:DOT": ".", "CUE:COMMA": ",", "CUE:SEMICOLON": ";", "CUE:COLON": ":"}


def decode_cue(cue: str) -> str:
    """G6d: a cue by its name, or itself."""
    found = CUES.get((cue or "").strip().upper(), cue)
    if found not in CUES.values():
        raise ValueError(f"no cue {cue!r}")
    return found


def with_starts(lines: DataFrame, marker: str = "*", exceptions: tuple[str, ...] = ()) -> DataFrame:
    """Lines with `start` by the mode that a marker names: CUE:*, NUMBERED (#NUM, #NUMDOT), UPPERCASE, else literal."""
    name = marker.strip().upper()
    line = F.col("line")
    if name == "UPPERCASE":
        return with_uppercase_starts(lines, exceptions)
    if name.startswith("CUE:"):
        cue = decode_cue(name)
        return lines.withColumn("start", cue_start(line, cue) if cue in ":;" else comma_or_dot_start(line))
    return lines.withColumn("start", numbered_start(line) if name in ("NUMBERED", "#NUM", "#NUMDOT") else literal_start(line, marker.strip() or "*"))


# A price, and heads that end in a colon or a dot.
_PRICE = r"(?:\$|Lps\.?|L)\s*\d{1,3}(?:[.,]\d{3})*(?:[.,]\d+)?"
_COLON_HEAD = r"(?:(?:Col\.|Res\.|Bo\.|Urb\.)\s+[A-ZÁÉÍÓÚÑ][^:]{1,50}|[A-ZÁÉÍÓÚÑ][^:]{2,50})\s*:"
_DOT_TITLE = r"(?<![\p{L}\p{N}_])[A-ZÁÉÍÓÚÜÑ]+(?:\s+[A-ZÁÉÍÓÚÜÑ]+)*\."


def _cut_before(text: Column, pattern: str, when) -> Column:
    """The text cut before the matches of a pattern for which when(what stands since the last cut, match, number) holds."""

    def walk(x: Column) -> Column:
        def step(state: Column, head: Column) -> Column:
            now = F.concat(state.now, F.get(x.gaps, state.i))
            cut = when(now, head, state.i)
            return F.struct((state.i + 1).alias("i"), F.when(cut, head).otherwise(F.concat(now, head)).alias("now"), F.when(cut, F.array_append(state.out, now)).otherwise(state.out).alias("out"))

        zero = F.struct(F.lit(0).alias("i"), F.lit("").alias("now"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(x.heads, zero, step, lambda s: F.array_append(s.out, F.concat(s.now, F.get(x.gaps, s.i))))

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("heads"))
    return F.filter(F.transform(let(parts, walk), lambda p: F.trim(p)), lambda p: p != "")


def split_after_price(line: Column, cue: str = ":") -> Column:
    """A line cut before each later head with a colon that follows a price; other cues cut nothing."""
    t = F.trim(F.coalesce(line, F.lit("")))
    return _cut_before(t, _COLON_HEAD, lambda now, head, i: now.rlike(_PRICE)) if cue == ":" else F.array(t)


def split_titles(line: Column, exceptions: tuple[str, ...] = ()) -> Column:
    """A run-on line cut before each later title in upper case that ends in a dot, unless it is an exception."""
    known = [squeeze(F.upper(F.lit(e))) for e in exceptions]
    title = lambda head: squeeze(F.regexp_replace(F.upper(head), r"\.$", ""))
    wanted = lambda now, head, i: (i > 0) & (~title(head).isin(*known) if known else F.lit(True))
    return _cut_before(F.trim(F.coalesce(line, F.lit(""))), _DOT_TITLE, wanted)


def explode_lines(lines: DataFrame, pieces: Column) -> DataFrame:
    """lines with each line replaced by its pieces (an array), numbered anew within a file."""
    each = lines.withColumn("__pieces", pieces).select(*[c for c in lines.columns if c != "line"], F.posexplode("__pieces").alias("__k", "line"))
    number = F.row_number().over(Window.partitionBy("file").orderBy("line_no", "__k")) - 1
    return each.withColumn("__n", number).withColumn("line_no", F.col("__n")).drop("__n", "__k").select(*lines.columns)


# Ends and starts of lines that belong together.
_CURRENCY_TAIL = r"(?iu)(?:US\$|USD|DOLARES|DÓLARES|\$|LPS?\.?|HNL)\s*(?:['\"”])?\s*$"
_PRICE_ONLY = r"(?i)^\s*(?:US\$|\$|L\.|LPS\.?|USD|HNL)?\s*\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})?\s*\.?\s*$"
_AREA = r"\d{1,4}(?:[.,]\d{3})*(?:[.,]\d{1,2})?\s*(?:m2|m²|mt2|mts2|mts|vrs2|vrs²|vrs|vr2|vr|varas?)(?![\w²])"
_NUMBERED = r"^(\s*)\d{1,3}[.\-_–—]{1,2}\s*(?=[A-Za-zÁÉÍÓÚÜÑ#])"
_INLINE_NUMBER = r"(?<![\d,])\b\d{1,3}\.\s*(?=[A-Za-zÁÉÍÓÚÜÑ#])"


def _glued(lines: DataFrame, joins: Column, shown: Column) -> DataFrame:
    """lines where each one that joins is added to the one before it, with a space."""
    rows = lines.withColumn("__join", joins).withColumn("__shown", shown)
    rows = rows.withColumn("__block", F.sum(F.when(F.col("__join"), 0).otherwise(1)).over(_by_file()))
    rows = rows.groupBy("file", "__block").agg(F.array_sort(F.collect_list(F.struct("line_no", "__shown"))).alias("__rows"))
    text = F.array_join(F.transform("__rows", lambda r: F.trim(r["__shown"])), " ")
    whole = F.when(F.size("__rows") == 1, F.get("__rows", 0)["__shown"]).otherwise(text)
    return rows.select("file", F.get("__rows", 0).line_no.alias("line_no"), whole.alias("line"))


def masquerade_numbered(lines: DataFrame) -> DataFrame:
    """Numbers such as 12. at a line's start or inside it become "* "; a price goes to the line whose end is a
    currency, a line to the area before it, and an area to any line before it."""
    line, before = F.col("line"), F.lag("line").over(_by_file())
    after = lambda pattern: F.coalesce(before.rlike(pattern), F.lit(False))
    numbered = line.rlike(_NUMBERED)
    joins = (after(_CURRENCY_TAIL) & line.rlike(_PRICE_ONLY)) | (after(rf"(?i){_AREA}\s*[.,;:]?\s*$") & ~numbered) | (before.isNotNull() & line.rlike(rf"(?i)^\s*{_AREA}"))
    shown = F.regexp_replace(F.regexp_replace(line, _NUMBERED, "$1* "), _INLINE_NUMBER, "* ")
    return _glued(lines, joins, F.when(joins, line).otherwise(shown))


def masquerade_freeform(lines: DataFrame, prefixes: tuple[str, ...] = (), threshold: int = 3) -> DataFrame:
    """Lines that score as starts get "* "; the others, lone page numbers, amounts after a currency and what follows
    an area are added to the line before; headers stand alone."""
    line, before = F.col("line"), F.lag("line").over(_by_file())
    header = line.rlike(HEADER)
    after = lambda pattern: F.coalesce(before.rlike(pattern), F.lit(False))
    starts = freeform_score(line, prefixes) >= threshold
    amount = after(r"(?:US\$|\$|USD|HNL|L\.|Lps\.|LPS\.)\s*$") & line.rlike(r"^\s*\d")
    area = after(r"(?iu)(?:m2|m²|vrs2?|vr2?)\s*[.,;:]?$") & ~F.ltrim(line).startswith("*")
    joins = before.isNotNull() & ~header & (line.rlike(r"^\s*\d{1,3}\s*[.)]?\s*$") | amount | area | ~starts)
    return _glued(lines, joins, F.when(~header & ~joins & starts, F.concat(F.lit("* "), F.ltrim(line))).otherwise(line))


def masquerade(lines: DataFrame, kind: str, prefixes: tuple[str, ...] = (), threshold: int = 3, min_hits: int = 5, min_percent: int = 1) -> DataFrame:
    """The files with hits enough (five; numbered also in 1 % of lines) masqueraded, the others as they are, and `used`."""
    line = F.col("line")
    hit = (line.rlike(_NUMBERED) | line.rlike(_INLINE_NUMBER)) if kind == "numbered" else freeform_score(line, prefixes) >= threshold
    share = min_percent if kind == "numbered" else 0
    gate = lines.groupBy("file").agg(F.sum(hit.cast("int")).alias("hits"), F.count("*").alias("n")).select("file", ((F.col("hits") >= min_hits) & (F.col("hits") * 100 >= F.col("n") * share)).alias("used"))
    own = lines.join(gate, "file")
    done = masquerade_numbered(own.where("used")) if kind == "numbered" else masquerade_freeform(own.where("used"), prefixes, threshold)
    return done.withColumn("used", F.lit(True)).unionByName(own.where("NOT used").select("file", "line_no", "line", "used"))


def with_ocr_starts(lines: DataFrame) -> DataFrame:
    """A symbol, an upper-case title with a colon, or a long line (over 30) after a short one (under 20) starts a listing."""
    w = _by_file()
    symbol = F.col("line").rlike(r"^\s*[*•>\-]\s*\S") | F.col("line").rlike(r"^\s*[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ .]+:")
    jump = (F.length(F.trim("line")) > 30) & (F.length(F.trim(F.coalesce(F.lag("line").over(w), F.lit("")))) < 20)
    return lines.withColumn("start", symbol | jump)


def detect_numbered(lines: DataFrame) -> DataFrame:
    """Per file, lines, numbered starts, and whether numbers are its markers (five and 1 % of lines at least)."""
    hit = F.sum(numbered_start(F.col("line")).cast("int"))
    return lines.groupBy("file").agg(F.count("*").alias("lines"), hit.alias("starts")).withColumn("numbered", (F.col("starts") >= 5) & (F.col("starts") * 100 >= F.col("lines")))


def listings(lines: DataFrame, start: Column | None = None, min_chars: int = 1) -> DataFrame:
    """(file, block_no, listing_no, kind, text): headers and listings in order.

    `start` marks listing starts (by default the column of that name); other lines join the open listing, those before the
    first start or header are dropped, as are continuations of a header. listing_no counts headers too, from 1.
    """
    rows = lines.withColumn("__header", F.col("line").rlike(HEADER)).withColumn("__start", (F.col("start") if start is None else start) & ~F.col("line").rlike(HEADER))
    opens = (F.col("__header") | F.col("__start")).cast("int")
    rows = rows.withColumn("block_no", F.sum(opens).over(_by_file())).where("block_no > 0 AND trim(line) <> ''")
    row = F.struct("line_no", F.trim("line").alias("line"), "__header")
    blocks = rows.groupBy("file", "block_no").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    kind = F.when(F.get("rows", 0)["__header"], "header").otherwise("listing")
    text = F.when(kind == "header", F.get("rows", 0).line).otherwise(F.array_join(F.transform("rows", lambda r: r.line), " "))
    out = blocks.select("file", "block_no", kind.alias("kind"), text.alias("text")).where((F.col("kind") == "header") | (F.length("text") >= min_chars))
    return out.withColumn("listing_no", F.row_number().over(Window.partitionBy("file").orderBy("block_no")))


def header_context(text: Column, headers: list[dict], marker: str = "#") -> Column:
    """(transaction, type, category) of a header line; the longest pattern that it holds wins, then the words for
    renting and selling."""
    h = F.trim(F.regexp_replace(text, rf"^\s*{marker}\s*", ""))
    found = F.struct(
        F.when(F.upper(h).rlike("ALQUIL|RENT"), "alquiler").when(F.upper(h).rlike("VENTA|SALE"), "venta").alias("transaction"), F.lit(None).cast("string").alias("type"), F.upper(h).alias("category")
    )
    for entry in sorted(headers, key=lambda e: len(e["pattern"])):
        own = F.struct(F.lit(entry.get("transaction")).cast("string").alias("transaction"), F.lit(entry.get("type")).cast("string").alias("type"), F.lit(entry.get("category") or entry["pattern"]).alias("category"))
        found = F.when(h.rlike(f"(?iu){entry['pattern']}"), own).otherwise(found)
    return found


def with_context(blocks: DataFrame, headers: list[dict]) -> DataFrame:
    """Listings with transaction, type and category of the headers above, each carried on by itself."""
    rows = blocks.withColumn("__context", F.when(F.col("kind") == "header", header_context(F.col("text"), headers)))
    rows = carried(rows, ["file"], ["block_no"], {name: F.col("__context")[name] for name in ("transaction", "type", "category")})
    return rows.where("kind = 'listing'").drop("__context", "kind")


def carried(df: DataFrame, by: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Df with each value carried forward within a group: the last one so far that is not null."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.last(v, ignorenulls=True).over(w) for name, v in values.items()})


def unique_headers(lines: DataFrame) -> DataFrame:
    """Distinct headers (file, header) in order of their first line, compared in upper case, with their place."""
    head = F.trim(F.regexp_replace("line", HEADER, ""))
    rows = lines.where(F.col("line").rlike(HEADER)).groupBy("file", F.upper(head).alias("__key")).agg(F.min(F.struct("line_no", head.alias("header"))).alias("x"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("x.line_no")).alias("place")
    return rows.select("file", "x.header", place)


def unique_lines(lines: DataFrame, start: Column) -> DataFrame:
    """Distinct marked lines under each header; headers, then lines in order of text, lines under no header last."""
    w = _by_file().rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("header", F.last(F.when(F.col("line").rlike(HEADER), F.trim("line")), ignorenulls=True).over(w))
    return rows.where(start).select("file", "header", F.trim("line").alias("line")).distinct().orderBy("file", F.col("header").asc_nulls_last(), "line")
