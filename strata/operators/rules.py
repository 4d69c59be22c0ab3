"""Ordered rule classification (CLS-01..04, ER-05, PRJ-08).

A rule set is data (a list of ``Rule``) folded into ONE ``CASE WHEN`` column:
first match wins, default otherwise. Keyword lists are parameters; nothing
business-specific is hard-coded here."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.core import as_col


@dataclass(frozen=True)
class Rule:
    """One condition -> label. ``kind``:
    - ``contains_any``: any keyword is a substring (regex-escaped, case-insensitive)
    - ``regex``: the pattern matches
    - ``in``: value (upper/trimmed) is in ``values``
    - ``like_prefix``: starts with any of ``values``
    - ``expr``: a ready ``Column`` predicate
    Several ``Rule``s with ``all_of`` are AND-ed (combined rules)."""

    column: str | None
    kind: str
    values: tuple = ()
    label: str = ""
    predicate: Column | None = None
    word_boundary: bool = False
    all_of: tuple = field(default_factory=tuple)


def _norm(col) -> Column:
    return F.upper(F.coalesce(as_col(col).cast("string"), F.lit("")))


def condition(rule: Rule) -> Column:
    if rule.all_of:
        cond = F.lit(True)
        for r in rule.all_of:
            cond = cond & condition(r)
        return cond
    if rule.kind == "expr":
        return F.coalesce(rule.predicate, F.lit(False))
    x = _norm(rule.column)
    if rule.kind == "contains_any":
        alt = "|".join(re.escape(v.upper()) for v in rule.values)
        if rule.word_boundary:
            alt = r"\b(?:" + alt + r")\b"
        return x.rlike("(?:" + alt + ")")
    if rule.kind == "regex":
        return x.rlike(rule.values[0])
    if rule.kind == "in":
        return F.trim(x).isin(*[v.upper() for v in rule.values])
    if rule.kind == "like_prefix":
        cond = F.lit(False)
        for v in rule.values:
            cond = cond | x.startswith(v.upper())
        return cond
    raise ValueError(f"unknown rule kind {rule.kind}")


def classify(rules: list[Rule], default: str | None = "N/S") -> Column:
    """First matching rule's label, else ``default``."""
    expr = None
    for r in rules:
        cond = condition(r)
        expr = F.when(cond, F.lit(r.label)) if expr is None else expr.when(cond, F.lit(r.label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def ticket_rules(admin: list[str], noc_users: list[str], physical: list[str], logical: list[str],
                 solution: str = "Solucion Aplicada", user: str = "Usuario Final", group: str = "Grupo Trabajo",
                 ops_group_pattern: str = "OPERACIONES|MESA DE CONTROL", user_marker: str = "NOC") -> list[Rule]:
    """CLS-01 order: admin solution -> user list -> group list -> user contains
    marker -> group regex -> physical solution -> logical solution; default N/S."""
    return [
        Rule(solution, "contains_any", tuple(admin), "ADMINISTRATIVO"),
        Rule(user, "in", tuple(noc_users), "NOC"),
        Rule(group, "in", tuple(noc_users), "NOC"),
        Rule(user, "contains_any", (user_marker,), "NOC"),
        Rule(group, "regex", (ops_group_pattern,), "OPERACIONES"),
        Rule(solution, "contains_any", tuple(physical), "OPERACIONES"),
        Rule(solution, "contains_any", tuple(logical), "NOC"),
    ]


# Free-text topic patterns of the data-update feed, in priority
# order (first match wins), and the default label.
TOPIC_RULES = [
    (r"TEL[EÉ]FONO|CELULAR|N[UÚ]MERO|TLF", "TELEFONO"),
    (r"CORREO|EMAIL|MAIL", "CORREO ELECTRÓNICO"),
    (r"C[EÉ]DULA|DOCUMENTO|C\.I|IDENTIDAD|RIF", "CEDULA"),
    (r"DIRECCI[OÓ]N|UBICACI[OÓ]N|CASA|CALLE|AVENIDA", "DIRECCION"),
    (r"NOMBRE|APELLIDO|TITULAR", "NOMBRE Y APELLIDO"),
    (r"CLAVE|CONTRASE[ÑN]A|PASSWORD|WIFI", "CLAVE / WIFI"),
    (r"PLAN|SERVICIO|PAQUETE|MEGAS|VELOCIDAD", "CAMBIO DE PLAN"),
]
TOPIC_DEFAULT = "OTRAS ACTUALIZACIONES"


def topic(col, rules: list[tuple[str, str]] = TOPIC_RULES, default: str = TOPIC_DEFAULT) -> Column:
    """CLS-02: free-text topic, regexes tested on the upper-cased text in order."""
    return classify([Rule(col, "regex", (p,), label) for p, label in rules], default)


def sales_channel(seller, detected_name, match_type, office_sellers: list[str], own_sellers: list[str]) -> Column:
    """CLS-03: CALL CENTER (tele-sales words) -> OFICINA COMERCIAL (a detected
    office match that is not pending/undetected and not an administrator, or a
    listed office seller) -> VENDEDORES PROPIOS (street sales words or a listed
    own seller) -> ALIADOS. Missing seller text behaves as the word ``none``."""
    v = F.lower(F.coalesce(as_col(seller).cast("string"), F.lit("none")))
    n = F.coalesce(as_col(detected_name).cast("string"), F.lit("nan"))
    t = F.coalesce(as_col(match_type).cast("string"), F.lit("nan"))
    office_hit = ((n != "nan") & (n != "") & (t != "Pendiente de Revisión") & (t != "No detectado")
                  & ~v.contains("administrador"))
    return (F.when(v.contains("televentas") | v.contains("call center"), F.lit("CALL CENTER"))
            .when(office_hit | v.isin(*[s.lower() for s in office_sellers]), F.lit("OFICINA COMERCIAL"))
            .when((v.contains("ventas") & ~v.contains("televentas")) | v.isin(*[s.lower() for s in own_sellers]),
                  F.lit("VENDEDORES PROPIOS"))
            .otherwise(F.lit("ALIADOS")))


def office_ownership(office, own_offices: list[str], own: str = "OFICINAS PROPIAS",
                     other: str = "ALIADOS Y DESARROLLO") -> Column:
    """CLS-04a: membership of the collecting office in the own-office list."""
    return F.when(F.coalesce(as_col(office).cast("string"), F.lit("")).isin(*own_offices), F.lit(own)).otherwise(F.lit(other))


def responsible_channel(responsible) -> Column:
    """CLS-04b: responsible user -> channel by keyword."""
    x = F.coalesce(as_col(responsible).cast("string"), F.lit(""))
    return (F.when(x.rlike("(?i)CALL|PHONE"), F.lit("CALL CENTER")).when(x.rlike("(?i)OFI|ASESOR"), F.lit("OFICINA COMERCIAL"))
            .otherwise(F.lit("ALIADOS")))


def app_or_manual(user, app_users: list[str]) -> Column:
    """CLS-04c: payments keyed by an integration user are ``App``, else ``Manual``."""
    return F.when(as_col(user).isin(*app_users), F.lit("App")).otherwise(F.lit("Manual"))
