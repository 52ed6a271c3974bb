"""JSON out of free text: fences, prose around it, truncation. Built-in parsing first; a vectorised function only for what fails."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def complete_objects(text: str) -> list[dict]:
    """Objects directly inside the first array that are complete, however the text ends."""
    decoder, at, out = json.JSONDecoder(), text.find("[") + 1, []
    while at > 0:
        at = text.find("{", at)
        if at < 0:
            break
        try:
            value, at = decoder.raw_decode(text, at)
            out.append(value)
        except json.JSONDecodeError:
            end = _closing(text, at)
            if end < 0:
                break
            at = end + 1  # a whole object, but not one that parses
    return out


def _closing(text: str, start: int) -> int:
    """Place of the brace that closes the one at start, quotes and escapes minded; -1 if none does."""
    depth = 0
    for m in re.finditer(r'"(?:[^"\\]|\\.)*"|[{}]', text[start:], re.DOTALL):
        depth += {"{": 1, "}": -1}.get(m[0], 0)
        if m[0] == "}" and depth == 0:
            return start + m.start()
    return -1


def recover(text: str | None) -> tuple[str | None, str]:
    """(JSON, how): strict, lenient (from the first to the last brace), recovered (complete objects of a cut array) or failed."""
    if not text:
        return None, "failed"
    fenced = re.search(r"```(?:json)?\s*(.*?)(?:```|\Z)", text, re.DOTALL)
    body = (fenced[1] if fenced else text).strip()
    for how, part in (("strict", body), ("lenient", body[body.find("{") : body.rfind("}") + 1])):
        try:
            return json.dumps(json.loads(part)), how
        except json.JSONDecodeError:
            continue
    found = complete_objects(body)
    return (json.dumps({"_recovered": found}), "recovered") if found else (None, "failed")


def _recovered(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([recover(t) for t in texts], columns=["json", "method"])


def parse_tolerant(text: Column) -> Column:
    """struct<json, method> of a model's reply."""
    return F.pandas_udf(_recovered, "json string, method string")(text)


def pairs_by_pattern(text: Column, a: str, b: str) -> Column:
    """Objects with just the keys ``a`` and ``b`` (in this order, strings without quotes inside) wherever they stand, as structs; anything else is passed over."""
    pattern = r'\{\s*"' + a + r'"\s*:\s*"([^"]*)"\s*,\s*"' + b + r'"\s*:\s*"([^"]*)"\s*\}'
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda o: F.struct(F.regexp_extract(o, pattern, 1).alias(a), F.regexp_extract(o, pattern, 2).alias(b)))


def simple_yaml(body: str) -> list[dict[str, str]] | None:
    """A list of flat maps with plain, quoted or block (| and >) values; a map that holds such a list under one key is that list. None for anything else: no YAML
    library is needed for what models are asked to write."""
    lines = [x.rstrip() for x in body.splitlines() if x.strip() and not x.lstrip().startswith("#")]
    if len(lines) > 1 and re.fullmatch(r"\w+:", lines[0]) and lines[1].lstrip().startswith("- "):
        lines = lines[1:]
    out: list[dict[str, str]] = []
    block: tuple[str, int] | None = None
    for line in lines:
        depth = len(line) - len(line.lstrip())
        if block and depth > block[1]:
            out[-1][block[0]] = f"{out[-1][block[0]]}\n{line.strip()}".strip()
            continue
        block = None
        item = re.match(r"\s*(- )?\s*([A-Za-z_]\w*):(?:\s+(.*))?$", line)
        if not item or (not item[1] and not out):
            return None
        if item[1]:
            out.append({})
        value = (item[3] or "").strip()
        if value in ("|", ">", "|-", ">-"):
            block, value = (item[2], depth + 2 * bool(item[1])), ""
        elif value[:1] in "\"'" and value:
            if len(value) < 2 or value[-1] != value[0]:
                return None
            value = value[1:-1]
        out[-1][item[2]] = value
    return out or None


def yaml_records(text: str | None, key: str = "record_id", nothing: tuple[str, ...] = ("no records extracted", "does not contain")) -> tuple[list[dict[str, str]], str]:
    """(records, how) of a reply: strict; recovered, where the end is cut and the last record with it; none, where the model says so; or failed."""
    if not text or any(x in text.lower() for x in nothing):
        return [], "none"
    fenced = re.search(r"```(?:yaml)?\s*(.*?)```", text, re.DOTALL)
    body = fenced[1] if fenced else re.sub(r"^```(?:yaml)?\s*\n?", "", text.strip())
    if found := simple_yaml(body):
        return found, "strict"
    starts = [m.start() for m in re.finditer(rf"^- {key}:", body, re.MULTILINE)]
    if not fenced and len(starts) > 1 and (found := simple_yaml(body[: starts[-1]])):
        return found, "recovered"
    return [], "failed"


def events(text: str | None) -> list[dict[str, str]]:
    """The events of a reply: fenced below an events heading, bare below it up to the next heading, else the first fenced list whose items are events and no records."""
    heading = re.search(r"(?:^|\n)\s*(?:#{1,4}\s*events|\*\*events\*\*)\s*\n", text or "", re.IGNORECASE)
    if heading:
        rest = text[heading.end() :]
        fence = re.match(r".{0,200}?```(?:yaml)?\s*\n(.*?)\n```", rest, re.DOTALL)
        bare = re.split(r"\n#{1,4}\s|\n---\s*\n|\n```", "\n" + rest)[0]
        for body in ([fence[1]] if fence else []) + [bare]:
            if found := simple_yaml(body):
                return found
    for body in re.findall(r"```(?:yaml)?\s*\n(.*?)\n```", text or "", re.DOTALL):
        found = simple_yaml(body)
        if found and {"event_id", "event_name"} <= found[0].keys() and "record_id" not in found[0]:
            return found
    return []


def _events(texts: pd.Series) -> pd.Series:
    return pd.Series([events(x) for x in texts], index=texts.index, dtype=object)


def parse_events(text: Column) -> Column:
    """array<map<string,string>> of a reply's events."""
    return F.pandas_udf(_events, "array<map<string,string>>")(text)


def _yaml(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([yaml_records(x) for x in texts], columns=["records", "method"])


def parse_yaml_records(text: Column) -> Column:
    """struct<records, method> of a reply in YAML."""

    return F.pandas_udf(_yaml, "records array<map<string,string>>, method string")(text)


def truncated(stop_reason: Column, output_tokens: Column, most: int) -> Column:
    return (stop_reason == "max_tokens") | (output_tokens >= F.lit(0.98) * most)
