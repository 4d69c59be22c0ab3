"""Branch traffic: silver consolidation with seller -> office resolution
(PL-18) and gold enrichment with the offices dimension (PL-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbage_to_null
from ..functions.core import c
from ..functions.dates import month_name_es
from ..operators.joins import map_enrich
from ..operators.quality import unmapped_values
from ..operators.resolve import prepare_master, resolve_with_fallback
from ..operators.sets import union_all_by_name
from ..operators.shape import conform

# The columns of the traffic tables, in their order.
TRAFFIC_COLUMNS = ["N° Abonado", "Documento", "Estatus", "Fecha", "Vendedor", "Grupo Afinidad", "Nombre Franquicia",
                   "Ciudad", "Tipo de afluencia", "Oficina", "Clasificacion", "Hora"]

# Keyword fallbacks for seller names without a master match.
KEYWORD_OFFICES = [
    (["INTERCOM", "INVERSIONES", "SOLUCIONES", "TECNOLOGIA", "AGENTE", "COMERCIALIZADORA"], "ALIADO / AGENTE"),
    (["CALLE"], "FUERZA DE VENTA EXTERNA"),
    (["TELEVENTAS", "CALL CENTER"], "TELEVENTAS / CALL CENTER"),
]
# Words that mark an employee entry as not a person.
NON_HUMAN_WORDS = ("INTERCOM", "INVERSIONES", "SOLUCIONES", "TECNOLOGIA", "TELECOMUNICACIONES", "MULTISERVICIOS", "COMERCIALIZADORA",
                   "CORPORACION", "SISTEMAS", "ASOCIADOS", "CONSORCIO", "GRUPO", "AGENTE", "ALIADO", "AUTORIZADO", "OFICINA",
                   "SUCURSAL", "CANAL", "TAQUILLA", "OFI", "OFIC", "OFC")


def traffic_silver(golds: dict[str, DataFrame], employees: DataFrame | None, universe: DataFrame | None,
                   keyword_rules=KEYWORD_OFFICES, threshold: float = 95.0,
                   non_human: tuple[str, ...] = NON_HUMAN_WORDS) -> DataFrame:
    """PL-18: the collections, sales and care golds conformed to one contract
    (PRJ-05) and stacked (SET-01); month name (SC-08); ``Oficina`` resolved from
    the seller: employee master, then advisor universe (ER-01/03), then keyword
    fallbacks, else the original office (ER-02)."""
    parts = [conform(g.withColumn("Tipo de afluencia", F.lit(k)) if "Tipo de afluencia" not in g.columns else g,
                     TRAFFIC_COLUMNS) for k, g in golds.items()]
    df = union_all_by_name(*parts).withColumn("Mes", F.lower(month_name_es(F.month("Fecha"))))
    masters = []
    if employees is not None:
        masters.append(prepare_master(employees, ["Nombre_Completo"], "OficinaSistema", exclude_regex=rf"\b({'|'.join(non_human)})\b"))
    if universe is not None:
        masters.append(prepare_master(universe, ["Nombre", "Apellido"], "Oficina"))
    if not masters and not keyword_rules:
        return df
    return resolve_with_fallback(df, "Vendedor", masters, keyword_rules, "Oficina", "Oficina", threshold)


def traffic_gold(silver: DataFrame, offices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PL-19: (gold, unmapped audit). Offices dictionary (CSV ``Input_Original``
    -> normalised name, state, site type) joined on upper/trim (JON-04; unmatched
    keep the original name and get ``Sin Asignar``); unmapped offices listed
    (DQ-03); garbage -> NULL (SC-01)."""
    g = map_enrich(silver, offices, "Oficina", "Input_Original",
                   {"Nombre_Normalizado_Final": "Oficina", "Estado": "Estado_Sede", "Tipo_Sede": "Tipo_Sede"},
                   fallback_col="Oficina")
    audit = unmapped_values(silver, "Oficina", offices, "Input_Original")
    strings = [f.name for f in g.schema.fields if f.dataType.simpleString() == "string"]
    return g.withColumns({n: garbage_to_null(c(n)) for n in strings}), audit
