"""Strict JSON checks as Columns over VARIANT, which keeps the JSON type of every value.

A rule is a property with its allowed types; ``violations`` lists every broken rule as ``path:keyword``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URI grammar of RFC 3986 (scheme, then authority and path or path alone, query, fragment).
_PCHAR = r"(?:[A-Za-z0-9\-._~!$&'()*+,;=:@]|%[0-9A-Fa-f]{2})"
_AUTHORITY = (r"(?:(?:[A-Za-z0-9\-._~!$&'()*+,;=:]|%[0-9A-Fa-f]{2})*@)?"
              r"(?:\[[0-9A-Fa-f:.]+\]|\[v[0-9A-Fa-f]+\.[A-Za-z0-9\-._~!$&'()*+,;=:]+\]|"
              r"(?:[A-Za-z0-9\-._~!$&'()*+,;=]|%[0-9A-Fa-f]{2})*)(?::[0-9]*)?")
URI_REGEX = (rf"^[A-Za-z][A-Za-z0-9+\-.]*:(?://{_AUTHORITY}(?:/{_PCHAR}*)*|/(?:{_PCHAR}+(?:/{_PCHAR}*)*)?|"
             rf"{_PCHAR}+(?:/{_PCHAR}*)*)(?:\?(?:{_PCHAR}|[/?])*)?(?:#(?:{_PCHAR}|[/?])*)?\z")

# Calendar dates (29 February in leap years only), time of day with optional fraction, zone.
_DAY = r"(?:0[1-9]|1[0-9]|2[0-8])"
_DATE = (rf"(?:[0-9]{{4}}-(?:(?:0[1-9]|1[0-2])-{_DAY}|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
         r"|(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)-02-29)")
_ZONE = r"(?:[Zz]|([+-])([01][0-9]|2[0-3])(?::?([0-5][0-9]))?)"
DATE_TIME_REGEX = rf"^{_DATE}[Tt\s]([01][0-9]|2[0-3]):([0-5][0-9]):[0-5][0-9](?:\.[0-9]+)?{_ZONE}\z"


def is_date_time(text: Column) -> Column:
    """Calendar date and time of day with a zone; a leap second counts only at 23:59:60 UTC."""
    earlier = F.regexp_replace(text, r"(:[0-5][0-9]):60", "$1:59")

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(earlier, DATE_TIME_REGEX, i).try_cast("int"), F.lit(0))

    zone = F.when(F.regexp_extract(earlier, DATE_TIME_REGEX, 3) == "-", -1).otherwise(1) * (part(4) * 60 + part(5))
    last_minute = F.pmod(part(1) * 60 + part(2) - zone, F.lit(1440)) == 1439
    return F.when(text.contains(":60"), earlier.rlike(DATE_TIME_REGEX) & last_minute).otherwise(
        text.rlike(DATE_TIME_REGEX))


def is_uri(text: Column) -> Column:
    return text.rlike(URI_REGEX)


_FORMATS = {"uri": is_uri, "date-time": is_date_time}


@dataclass(frozen=True)
class Rule:
    """Checks of one property. ``integer`` also satisfies ``number``, ``1.0`` counts as an integer."""

    path: str
    types: tuple[str, ...]
    required: bool = False
    format: str | None = None
    enum: tuple[str, ...] = ()
    minimum: float | None = None

    @property
    def name(self) -> str:
        return self.path.removeprefix("$.")

    @property
    def parent(self) -> str:
        return self.path.rpartition(".")[0]


def type_names(doc: Column, rules: list[Rule]) -> Column:
    """VARIANT type names of the document and of all properties with rules, null where a key is absent.

    A column of its own: the names are dear to get and are looked at many times.
    """
    return F.struct(F.schema_of_variant(doc).alias("$"),
                    *[F.schema_of_variant(F.variant_get(doc, rule.path, "variant")).alias(rule.path) for rule in rules])


def _has_type(names: Column, doc: Column, path: str, types: tuple[str, ...]) -> Column:
    """Whether a present value has one of the JSON types."""
    name = names.getField(path)
    whole = name.isin("TINYINT", "SMALLINT", "INT", "BIGINT")
    number = whole | name.isin("FLOAT", "DOUBLE") | name.startswith("DECIMAL")
    value = F.try_variant_get(doc, path, "double")
    tests = {"string": name == "STRING", "null": name == "VOID", "boolean": name == "BOOLEAN", "number": number,
             "object": name.startswith("OBJECT"), "array": name.startswith("ARRAY"),
             "integer": whole | (number & (value == F.floor(value)))}
    return reduce(lambda a, b: a | b, [tests[t] for t in types])


def _broken(doc: Column, names: Column, rule: Rule) -> list[Column]:
    """One Column per keyword: its code when the keyword is broken, else an empty text."""
    present = names.getField(rule.path).isNotNull()
    checks = {"type": present & ~_has_type(names, doc, rule.path, rule.types)}
    if rule.required:
        in_object = F.coalesce(names.getField(rule.parent).startswith("OBJECT"), F.lit(False))
        checks = {"required": in_object & ~present, **checks}
    text = F.try_variant_get(doc, rule.path, "string")
    is_text = _has_type(names, doc, rule.path, ("string",))
    if rule.format:
        checks["format"] = present & is_text & ~_FORMATS[rule.format](text)
    if rule.enum:
        checks["enum"] = present & ~(is_text & text.isin(*rule.enum))
    if rule.minimum is not None:
        number = F.try_variant_get(doc, rule.path, "double")
        checks["minimum"] = present & _has_type(names, doc, rule.path, ("number",)) & (number < rule.minimum)
    return [F.when(broken, F.lit(f"{rule.name}:{keyword}")).otherwise("") for keyword, broken in checks.items()]


def violations(doc: Column, names: Column, value: Column, rules: list[Rule], closed: bool = False) -> Column:
    """All broken rules of a JSON document, in rule order; ``closed`` rejects keys without a rule."""
    codes = F.array_remove(F.array(*[code for rule in rules for code in _broken(doc, names, rule)]), "")
    if closed:
        keys = F.array_except(F.json_object_keys(value), F.array(*[F.lit(r.name) for r in rules]))
        codes = F.concat(codes, F.transform(F.coalesce(keys, F.array().cast("array<string>")),
                                            lambda key: F.concat(key, F.lit(":unknown"))))
    return F.when(names.getField("$").startswith("OBJECT"), codes).otherwise(F.array(F.lit("document:type")))
