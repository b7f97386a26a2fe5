"""Configuration: coercion, flattening, column selection, merges and overrides."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable
from pathlib import Path
from typing import Any


def load(source: dict | str | Path) -> dict:
    """A dict as it is; a path by its suffix (JSON, TOML, YAML where the library is there); else JSON text."""
    if isinstance(source, dict):
        return source
    path = Path(source)
    suffix = path.suffix.lower()
    if suffix == ".toml":
        import tomllib

        return tomllib.loads(path.read_text("utf-8-sig"))
    if suffix in (".yaml", ".yml"):
        import yaml

        return yaml.safe_load(path.read_text("utf-8-sig"))
    return json.loads(path.read_text("utf-8-sig") if suffix == ".json" else str(source))


def flatten(value: Any, prefix: str = "") -> dict[str, Any]:
    """A.b[0] keys to scalars."""
    if isinstance(value, dict):
        return {k: v for key, x in value.items() for k, v in flatten(x, f"{prefix}.{key}" if prefix else str(key)).items()}
    if isinstance(value, list):
        return {k: v for i, x in enumerate(value) for k, v in flatten(x, f"{prefix}[{i}]").items()}
    return {prefix: value}


TRANSFORMS: dict[str, Callable[[Any], Any]] = {
    "lower": lambda x: x.lower() if isinstance(x, str) else x,
    "upper": lambda x: x.upper() if isinstance(x, str) else x,
    "strip": lambda x: x.strip() if isinstance(x, str) else x,
    "boolify": lambda x: str(x).strip().lower() in ("1", "true", "yes", "y", "si", "sí"),
    "int": lambda x: int(float(x)) if x not in (None, "") else None,
    "float": lambda x: float(x) if x not in (None, "") else None,
    "json": lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True),
    "join": lambda x: "|".join(map(str, x)) if isinstance(x, list) else x,
}


def matrix(configs: dict[str, dict], include: str | None = None, exclude: str | None = None, transforms: dict[str, str] | None = None) -> list[dict[str, Any]]:
    """A row for each config, a column for each flattened key that include matches and exclude does not."""
    flat = {name: flatten(c) for name, c in configs.items()}
    keys = sorted({k for f in flat.values() for k in f})
    keys = [k for k in keys if (not include or re.search(include, k)) and not (exclude and re.search(exclude, k))]
    change = lambda k, v: TRANSFORMS[transforms[k]](v) if transforms and k in transforms else v
    return [{"config": name, **{k: change(k, f.get(k)) for k in keys}} for name, f in sorted(flat.items())]


def merge_aliases(maps: list[dict[str, str]], first_wins: bool = True) -> dict[str, str]:
    """One map of aliases; the first (or the last) map that names one decides."""
    out: dict[str, str] = {}
    for m in maps if first_wins else reversed(maps):
        for k, v in m.items():
            out.setdefault(k, v)
    return out


def common_config(configs: list[dict], share: float = 0.5) -> dict[str, Any]:
    """Per flattened key the value that at least the share of the configs have."""
    counts: dict[str, Counter] = {}
    for c in configs:
        for k, v in flatten(c).items():
            counts.setdefault(k, Counter())[json.dumps(v, sort_keys=True)] += 1
    return {k: json.loads(v) for k, n in sorted(counts.items()) for v, x in [max(n.items(), key=lambda i: (i[1], i[0]))] if x >= share * len(configs)}


def overrides(config: dict, base: dict[str, Any]) -> dict[str, Any]:
    """Flattened keys whose value differs from the base."""
    return {k: v for k, v in flatten(config).items() if base.get(k, None) != v}


def infer_schema(configs: list[dict]) -> dict[str, str]:
    """Per flattened key (list places made one) the types seen, joined by a bar."""
    seen: dict[str, set[str]] = {}
    for c in configs:
        for k, v in flatten(c).items():
            seen.setdefault(re.sub(r"\[\d+\]", "[]", k), set()).add("null" if v is None else type(v).__name__)
    return {k: "|".join(sorted(v)) for k, v in sorted(seen.items())}


def joined_columns(row: dict[str, Any], name: str, sep: str = ",") -> str | None:
    """The values of name[0], name[1], ... of a flattened configuration, in order; nothing where there is none."""
    found = sorted((int(m[1]), v) for k, v in row.items() if (m := re.search(rf"(?i)(?:^|\.){re.escape(name)}\[(\d+)\]$", k)) and v is not None)
    return sep.join(str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for _, v in found) or None


def symbols(config: dict, agency: str | None) -> list[str]:
    """The marks of an agency's listings: its own, else the general ones, else the usual ones."""
    own = (config.get("agencies") or {}).get((agency or "").strip().upper(), {})
    marked = (own.get("listing_markers") or {}).get("symbols") or own.get("symbols")
    return list(marked or config.get("listing_symbols") or config.get("symbols") or ["*", "•", ">"])


def column_list(spec: str | list[str], *, read: Callable[[str], str] | None = None) -> list[str]:
    """A list, "a, b", a text file of names, or json:file:key.path."""
    if isinstance(spec, list):
        return spec
    read = read or (lambda p: Path(p).read_text("utf-8-sig"))
    if spec.startswith("json:"):
        _, path, keys = spec.split(":", 2)
        value = json.loads(read(path))
        for k in keys.split("."):
            value = value[k]
        return list(value)
    if spec.endswith(".txt"):
        return [x.strip() for x in read(spec).splitlines() if x.strip() and not x.lstrip().startswith(("#", "//"))]
    return [x.strip() for x in spec.split(",") if x.strip()]


def guess_header(line: str) -> dict[str, str | None]:
    """Transaction and type that the words of a section header name."""
    words = line.replace("＃", "#").lstrip("# ").strip().upper()
    tx = "Rent" if re.search("ALQUIL|RENTA|RENT", words) else "Sale" if re.search("VENTA|VENDE|SALE", words) else None
    kind = next((v for k, v in (("CASA", "House"), ("APART", "Apartment"), ("APTO", "Apartment"), ("TERRENO", "Land"), ("LOTE", "Land"), ("LOCAL", "Commercial"), ("OFICINA", "Commercial"), ("BODEGA", "Commercial")) if k in words), None)
    return {"pattern": words, "transaction": tx, "type": kind, "category": words}


def mnemonics(configs: list[dict], known: dict[str, str] | None = None) -> dict[str, str]:
    """Agency to mnemonic from configs; what is known already stays."""
    return dict(known or {}) | {c["agency"]: c["nemonic"].strip() for c in configs if c.get("agency") and (c.get("nemonic") or "").strip() and c["agency"] not in (known or {})}
