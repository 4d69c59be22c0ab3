"""Recurrence, Pareto, journey and friction analyses over a tickets table
(AN-01..15). Column roles are parameters (``TicketCols``) so the same jobs
run on any silver table with contract/cause/open/close/solution/group."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach_scalar

from ..functions.core import c
from ..functions.dates import band, days_between, round_half_even
from ..operators.aggregates import first_appearance_concat, fixed_width_histogram, ordered_concat
from ..operators.ordering import top_n_filter
from ..operators.rules import app_or_manual
from ..operators.windows import running_total


@dataclass(frozen=True)
class TicketCols:
    contract: str = "N° Contrato"
    cause: str = "Detalle Orden"
    opened: str = "Fecha Apertura"
    closed: str = "Fecha Cierre"
    solution: str = "Solucion Aplicada"
    group: str = "Grupo Trabajo"
    period: str = "Quincena Evaluada"
    period_key: str = "Orden_Quincena"
    ticket: str = "N° Orden"


def survival(df: DataFrame, k: TicketCols = TicketCols(), bucket_unit: str | None = "month") -> DataFrame:
    """AN-01: next opening of the same contract and cause; survival days =
    next opening - this close (fractional days, floored at 0; last ticket NULL).
    The lead is bucketed by ``bucket_unit`` of the opening (skew-safe for a hot
    contract); ``None`` uses one window per contract and cause."""
    from ..operators.windows import next_value, time_bucket

    bucket = time_bucket(df, k.opened, bucket_unit)
    out = next_value(df, [k.contract, k.cause], [c(k.opened), c(k.ticket)], k.opened, "Siguiente_Apertura", bucket=bucket)
    return out.withColumn("Supervivencia_Dias", days_between(F.col("Siguiente_Apertura"), c(k.closed), clip_zero=True))


def recurrence_groups(df: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-02: per period x contract x cause: repetitions, distinct attended dates
    and solutions in order of appearance, mean survival (1 decimal); > 1 only.
    The ordered lists are skew-safe two-phase aggregations joined on the keys."""
    keys = [k.period_key, k.period, k.contract, k.cause]
    order = [c(k.opened), c(k.ticket)]
    df = df.dropna(subset=keys)  # a NULL key is no group
    g = df.groupBy(*[c(x) for x in keys]).agg(
        F.count(F.lit(1)).alias("Repeticiones"),
        round_half_even(F.avg("Supervivencia_Dias"), 1).alias("Promedio_Supervivencia_Dias")).filter(F.col("Repeticiones") > 1)
    dates = first_appearance_concat(df, keys, F.to_date(c(k.opened)), order, "; ", "Fechas_Atendidas")
    sols = first_appearance_concat(df, keys, c(k.solution), order, "; ", "Soluciones")
    out = g.join(dates, keys, "left").join(sols, keys, "left")
    return out.select(*[c(x) for x in keys], "Repeticiones", "Fechas_Atendidas", "Soluciones", "Promedio_Supervivencia_Dias")


def pareto_by_cause(groups: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-03: causes ranked by tickets involved, share % and cumulative % (80/20).
    Runs on the aggregated recurrence table (one row per cause)."""
    r = groups.groupBy(c(k.cause)).agg(
        F.count_distinct(c(k.contract)).alias("Casos_Afectados"),
        F.sum("Repeticiones").alias("Total_Tickets_Involucrados"),
        round_half_even(F.avg("Promedio_Supervivencia_Dias"), 1).alias("Supervivencia_Promedio_Dias"))
    tot = r.agg(F.sum("Total_Tickets_Involucrados").alias("__t"))
    r = attach_scalar(r, tot).withColumn("__share", F.col("Total_Tickets_Involucrados") / F.col("__t") * 100)
    r = running_total(r, "__share", [F.col("Total_Tickets_Involucrados").desc(), c(k.cause).asc()], "__pareto")
    return (r.withColumn("Pct_Del_Total", round_half_even(F.col("__share"), 2))
            .withColumn("Pct_Acumulado_Pareto", round_half_even(F.col("__pareto"), 2))
            .drop("__t", "__share", "__pareto"))


def evolution(groups: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-04: the same indicators per period, ordered by the period sort key."""
    return (groups.groupBy(c(k.period_key), c(k.period)).agg(
        F.count_distinct(c(k.contract)).alias("Casos_Afectados"),
        F.sum("Repeticiones").alias("Total_Tickets_Involucrados"),
        round_half_even(F.avg("Promedio_Supervivencia_Dias"), 1).alias("Supervivencia_Promedio_Dias"))
        .orderBy(c(k.period_key)))


def friction(df: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-05: per period x contract: tickets, solution journey (distinct, in
    opening order, ' ➔ '), distinct causes and solutions; > 1 ticket only."""
    keys = [k.period_key, k.period, k.contract]
    df = df.dropna(subset=keys)  # a NULL key is no group
    g = df.groupBy(*[c(x) for x in keys]).agg(
        F.count(F.lit(1)).alias("Total_Tickets"),
        F.count_distinct(c(k.cause)).alias("Cantidad_Causas_Distintas"),
        F.count_distinct(c(k.solution)).alias("Cantidad_Soluciones_Distintas")).filter(F.col("Total_Tickets") > 1)
    j = first_appearance_concat(df, keys, c(k.solution), [c(k.opened), c(k.ticket)], " ➔ ", "Viaje_Soluciones")
    return g.join(j, keys, "left").select(*[c(x) for x in keys], "Total_Tickets", "Viaje_Soluciones",
                                          "Cantidad_Causas_Distintas", "Cantidad_Soluciones_Distintas")


def cause_journey(df: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-05, the journey of causes: per period x contract with several tickets, every cause in opening order, equal
    ones as often as they came (a group's string is as long as its tickets are many)."""
    keys = [k.period_key, k.period, k.contract]
    g = df.dropna(subset=keys).groupBy(*[c(x) for x in keys]).agg(
        F.count(F.lit(1)).alias("Total_Tickets"),
        ordered_concat(c(k.cause), [c(k.opened), c(k.ticket)], " ➔ ", distinct=False).alias("Viaje_Fallas"),
        F.count_distinct(c(k.cause)).alias("Cantidad_Causas_Distintas"))
    return g.filter(F.col("Total_Tickets") > 1)


def virtual_payments(payments: DataFrame, app_users: list[str], office_marker: str = "VIRTUAL") -> dict[str, DataFrame]:
    """AN-13: payments counted by user, date, form and office; those of the integration users by office, user and form;
    those of the offices whose name holds the marker likewise, and by category. Rows without a key are in no group."""
    user, date, form, office = "Usuario", "Fecha", "Forma de Pago", "Oficina Cobro"
    df = payments.withColumn("Categoria", app_or_manual(c(user), app_users))

    def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.dropna(subset=keys).groupBy(*[c(x) for x in keys]).agg(F.count(F.lit(1)).alias("cantidad"))

    by_app, virtual = df.filter(c(user).isin(*app_users)), df.filter(F.contains(c(office), F.lit(office_marker)))
    return {"General": counted(df, [user, date, form, office]), "Usuarios_App": counted(by_app, [office, user, form]),
            "Oficinas_Virtuales": counted(virtual, [office, user, form]), "Categorias_Virtuales": counted(virtual, ["Categoria"])}


def journey_ranking(fr: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-06."""
    return (fr.groupBy("Viaje_Soluciones").agg(F.count_distinct(c(k.contract)).alias("Casos_Afectados"),
                                               F.sum("Total_Tickets").alias("Total_Tickets_Involucrados"))
            .orderBy(F.col("Casos_Afectados").desc(), "Viaje_Soluciones"))


def lifetime_journey(fr: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-07: per contract, period journeys joined with ' || ' in period order
    (one entry per period, so the list is bounded by the number of periods),
    tickets summed, affected periods listed."""
    order = [c(k.period_key), c(k.period)]
    g = fr.groupBy(c(k.contract)).agg(
        ordered_concat("Viaje_Soluciones", order, " || ", distinct=False).alias("Viaje_Soluciones_Completo"),
        F.sum("Total_Tickets").alias("Total_Tickets_Periodo"))
    q = first_appearance_concat(fr, [k.contract], c(k.period), order, ", ", "Quincenas_Afectadas")
    return g.join(q, [k.contract], "left").orderBy(F.col("Total_Tickets_Periodo").desc(), c(k.contract))


def repeat_rate(surv: DataFrame, k: TicketCols = TicketCols(), min_tickets: int = 20) -> DataFrame:
    """AN-08: per work group: tickets, reopened tickets (a next opening exists),
    mean survival, repeat rate %; groups with fewer than ``min_tickets`` dropped."""
    g = surv.dropna(subset=[k.group]).groupBy(c(k.group)).agg(
        F.count(c(k.ticket)).alias("Total_Tickets_Atendidos"),
        F.count_if(F.col("Siguiente_Apertura").isNotNull()).alias("Tickets_Reincidentes"),
        round_half_even(F.avg("Supervivencia_Dias"), 2).alias("Dias_Prom_Reincidencia"))
    g = g.withColumn("Tasa_Reincidencia_Pct",
                     round_half_even(F.col("Tickets_Reincidentes") / F.col("Total_Tickets_Atendidos") * 100, 2))
    return g.filter(F.col("Total_Tickets_Atendidos") >= min_tickets).orderBy(F.col("Tickets_Reincidentes").desc(), c(k.group))


def case_file(df: DataFrame, fr: DataFrame, k: TicketCols = TicketCols()) -> DataFrame:
    """AN-09: every ticket of contracts with friction, chronological."""
    keys = fr.select(c(k.contract).alias("__k")).distinct()
    return (df.join(keys, c(k.contract) == F.col("__k"), "left_semi")
            .orderBy(c(k.contract), c(k.opened), c(k.ticket)))


def early_churn(df: DataFrame, last_cut: str, last_payment: str, status: str, exclude_prefix: str | None = None,
                active: str = "ACTIVO") -> DataFrame:
    """AN-10: day gap between last finished cut and last payment, banded
    0/30/60/120, non-active only, largest gaps first."""
    out = df.withColumn("dias", F.datediff(F.to_date(c(last_cut)), F.to_date(c(last_payment))))
    out = out.withColumn("marca_clase", F.when((F.col("dias") >= 30) & (F.col("dias") < 60), 30)
                         .when((F.col("dias") >= 60) & (F.col("dias") < 120), 60).when(F.col("dias") >= 120, 120).otherwise(0))
    out = out.filter(c(status) != active)
    if exclude_prefix:
        out = out.filter(~c(status).startswith(exclude_prefix))
    return out.orderBy(F.col("dias").desc_nulls_last())


def top_solutions_histogram(df: DataFrame, category: str, minutes: str, n: int = 5, width: float = 60.0) -> DataFrame:
    """AN-11: the ``n`` most frequent categories, then a fixed-width minute
    histogram of their rows."""
    top = top_n_filter(df.withColumn("__one", F.lit(1)), category, "__one", n)
    return fixed_width_histogram(top, minutes, width)


def reconcile(metrics: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """AN-12: the same metric from several golds side by side (full outer on key)."""
    out = None
    for name, df in metrics.items():
        d = df.select(c(key), c(value).alias(name))
        out = d if out is None else out.join(d, key, "full_outer")
    return out
