"""Cost-model operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import br_number, period_to_date, to_double
from ..functions.search import count_upto
from . import columns, filters, joins, stats, windows
from .ranks import surrogate_key

# fixed values: factor differences that separate the recommendations
KEEP_LIMIT, LIGHT_LIMIT = 0.02, 0.05
KEEP, LIGHT, REVIEW, NO_DATA = "KEEP", "LIGHT_ADJUSTMENT", "REVIEW", "INSUFFICIENT_DATA"


def relative_to_baseline(means: DataFrame, baseline: Column, mean: str, digits: int = 4) -> DataFrame:
    """Factor against the baseline row's mean, and its deviation in percent."""
    base = joins.scalar_baseline(means, baseline, mean)
    out = means.withColumn("factor", F.round(F.try_divide(F.col(mean), base), digits))
    return out.withColumn("deviation_pct", F.round((F.col("factor") - 1) * 100, 2))


def empirical_factors(
    fact: DataFrame,
    region: str,
    date: str,
    value: str,
    baseline: str,
    months: int | None = 12,
    digits: int = 2,
) -> DataFrame:
    """Mean of the last months per region over the baseline region's mean, ordered by factor.

    ``months=None`` takes the fact as it is, for callers that cut the period in the raw scan.
    """
    recent = fact if months is None else filters.last_n_months(fact, date, months)
    means = stats.group_stats(recent, [region], value, date, digits)
    return relative_to_baseline(means, F.col(region) == baseline, "avg_value").orderBy("factor", region)


def compare_factors(
    theory: DataFrame, empirical: DataFrame, key: str, expected: str, actual: str, limit: float = LIGHT_LIMIT
) -> DataFrame:
    """Full outer comparison with difference, significance and recommendation, largest gap first."""
    both = joins.full_outer_compare(theory, empirical, [key])
    diff = F.round(F.col(actual) - F.col(expected), 4)
    pct = F.round((F.try_divide(F.col(actual), F.col(expected)) - 1) * 100, 2)
    size = F.abs("diff_abs")
    advice = (
        F.when(size.isNull(), NO_DATA)
        .when(size <= KEEP_LIMIT, KEEP)
        .when(size <= LIGHT_LIMIT, LIGHT)
        .otherwise(REVIEW)
    )
    return (
        both.withColumns({"diff_abs": diff, "diff_pct": pct})
        .withColumns({"significant": F.coalesce(size > limit, F.lit(False)), "advice": advice})
        .orderBy(size.desc_nulls_last(), key)
    )


def apply_factors(
    dim: DataFrame, comparison: DataFrame, key: str, current: str, base_factor: str, actual: str = "factor"
) -> DataFrame:
    """Use the empirical factor where the comparison advises it; record where it came from."""
    ref = comparison.select(key, F.col(actual).alias("_actual"), F.col("advice").alias("_advice"))
    out = dim.join(ref, key, "left")
    adjust = F.coalesce(F.col("_advice").isin(LIGHT, REVIEW), F.lit(False))
    final = F.when(adjust, F.coalesce("_actual", current)).otherwise(F.col(current))
    origin = F.when(F.col("_advice").isNull(), "UNMATCHED").when(adjust, "EMPIRICAL").otherwise("THEORY_KEPT")
    return (
        out.withColumns({"final_factor": final, "factor_origin": origin})
        .withColumn("regional_cost_factor", F.round(F.col(base_factor) * F.col("final_factor"), 4))
        .drop("_actual", "_advice")
    )


def stable_jitter(key: Column, half_width: float = 0.02, steps: int = 997) -> Column:
    """Deterministic offset in ``[-half_width, +half_width]`` from a hash of the key."""
    bits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (F.pmod(bits, F.lit(2 * steps + 1)) - steps) * (half_width / steps)


def expand_regional(
    methods: DataFrame, places: DataFrame, specific: DataFrame, region_factors: DataFrame,
    method_key: str, place_key: str, region: str, cost_base: str, time_base: str,
) -> DataFrame:
    """Methods by places with the resolved factor: the place's own, else its region's plus jitter; ``id`` counts them in key order."""
    resolved = places.join(specific, place_key, "left").join(region_factors, region, "left")
    regional = F.round(F.col("region_factor") + stable_jitter(F.col(place_key)), 3)
    resolved = resolved.withColumn("place_factor", F.coalesce(F.col("specific_factor"), regional))
    grid = joins.cross_product(methods, resolved.drop("specific_factor", "region_factor"))
    return surrogate_key(grid, [method_key, place_key]).withColumns(
        {
            "cost_factor": F.round(F.col("place_factor") * F.col(cost_base), 2),
            "time_factor": F.round(F.col("place_factor") * F.col(time_base), 3),
        }
    )


def weighted_composite(
    fact: DataFrame, weights: DataFrame, member: str, keys: Sequence[str], value: str, digits: int = 2
) -> DataFrame:
    """Category cost as the weighted sum of its active members; a missing member counts zero."""
    active = weights.filter(F.col("is_active")).select(member, "category", "weight")
    summed = fact.join(active, member).groupBy(*keys, "category").agg(F.sum(F.col(value) * F.col("weight")).alias("_c"))
    return summed.withColumn("composite", F.round("_c", digits)).drop("_c")


# fixed values: labour share of construction value, and fees per square metre
LABOUR_SHARE = 0.60
FEES_PER_M2 = {"permit_fee": 5.0, "occupancy_fee": 3.0, "approval_fee": 2.0, "fire_fee": 1.5}


def construction_taxes(
    projects: DataFrame, rates: DataFrame, city: str, land: str, building: str, area: str
) -> DataFrame:
    """Transfer tax on land, service tax on labour, per-area fees, totals and share of investment.

    A city without rates keeps its row with NULL taxes and an error text.
    """
    out = projects.join(rates, city, "left").withColumns(
        {
            "transfer_tax": F.col(land) * F.col("transfer_rate") / 100,
            "service_base": F.col(building) * LABOUR_SHARE,
            **{fee: F.col(area) * per_m2 for fee, per_m2 in FEES_PER_M2.items()},
        }
    )
    out = out.withColumn("service_tax", F.col("service_base") * F.col("service_rate") / 100)
    fees = reduce(lambda a, b: a + b, [F.col(f) for f in FEES_PER_M2])
    out = out.withColumn("total_fees", fees)
    out = out.withColumn("total", F.col("transfer_tax") + F.col("service_tax") + F.col("total_fees"))
    share = F.try_divide(F.col("total"), F.col(land) + F.col(building)) * 100
    unknown = F.when(F.col("transfer_rate").isNull(), F.concat(F.lit("no rates for "), F.col(city)))
    return out.withColumns({"pct_of_investment": share, "error": unknown})


# fixed values: financing programmes (code, name, yearly rate %, months, financed %, income limit,
# price limit, kind)
PROGRAMS = [
    ("MCMV_FAIXA_1", "Minha Casa Minha Vida - Faixa 1", 4.00, 420, 100.0, 2640.0, 170000.0, "SUBSIDIADO"),
    ("MCMV_FAIXA_2", "Minha Casa Minha Vida - Faixa 2", 4.75, 420, 90.0, 4400.0, 264000.0, "SUBSIDIADO"),
    ("MCMV_FAIXA_3", "Minha Casa Minha Vida - Faixa 3", 7.66, 420, 80.0, 8000.0, 350000.0, "SUBSIDIADO"),
    ("SBPE_TAXA_REFERENCIAL", "SBPE - Taxa Referencial (TR)", 10.49, 420, 80.0, None, None, "MERCADO"),
    ("SBPE_POUPANCA", "SBPE - Poupança CAIXA", 9.99, 420, 80.0, None, None, "MERCADO"),
    ("SBPE_IPCA", "SBPE - IPCA", 4.95, 360, 80.0, None, None, "MERCADO"),
    ("SBPE_TAXA_FIXA", "SBPE - Taxa Fixa", 11.49, 360, 80.0, None, None, "MERCADO"),
    ("PRO_COTISTA_FGTS", "Pró-Cotista FGTS", 8.66, 420, 80.0, None, 1500000.0, "FGTS"),
    ("CONSTRUCAO_INDIVIDUAL", "Construção em Terreno Próprio", 10.99, 420, 70.0, None, None, "MERCADO"),
]
# fixed values: order in which programmes are tried
PROGRAM_ORDER = ["MCMV_FAIXA_1", "MCMV_FAIXA_2", "MCMV_FAIXA_3", "PRO_COTISTA_FGTS", "SBPE_TAXA_REFERENCIAL"]
PROGRAM_SCHEMA = (
    "program string, program_name string, yearly_rate double, months int, financed_pct double, "
    "income_limit double, price_limit double, kind string"
)
INCOME_SHARE = 0.30


def program_params(spark, kind: str | None = None, prefix: str | None = None) -> DataFrame:
    """Programme table with the order in which programmes are tried (NULL: never automatic)."""
    df = spark.createDataFrame(PROGRAMS, PROGRAM_SCHEMA)
    order = F.array_position(F.array(*[F.lit(p) for p in PROGRAM_ORDER]), F.col("program"))
    df = df.withColumn("priority", F.nullif(order, F.lit(0).cast("bigint")))
    if kind:
        df = df.filter(F.col("kind") == kind)
    if prefix:
        df = df.filter(F.col("program").startswith(prefix))
    return df


PROGRAM_TERMS = ("program", "yearly_rate", "months", "financed_pct")
LIMIT_CELLS = 1024
NODE = 1 << 40  # nodes of one level of the tree over the places of limits


@dataclass(frozen=True)
class LimitLine:
    """The distinct limits of one kind in order: their number, quantiles of them as borders of cells and, where the borders are not all of
    them, runs of the limits by cell with the place of the first."""

    n: int
    borders: list[float]
    runs: DataFrame | None

    def place(self, df: DataFrame, col: str, name: str) -> DataFrame:
        """Add how many limits lie below the value: its place on the line, behind all limits if it is missing."""
        x, edges = F.col(col).cast("double"), F.lit(self.borders).cast("array<double>")
        cell = F.when(x.isNotNull(), count_upto(edges, x, len(self.borders), below=True))
        if self.runs is None:
            return df.withColumn(name, F.coalesce(cell, F.lit(self.n)).cast("bigint"))
        beside = df.withColumn("_at", cell).join(self.runs, F.col("_at") == F.col("_cell"), "left")
        place = F.col("_before") + count_upto(F.col("_limits"), x, 1 << 20, below=True)
        return beside.withColumn(name, F.coalesce(place, F.lit(self.n)).cast("bigint")).select(*df.columns, name)


def limit_lines(programs: DataFrame, limits: Sequence[str]) -> list[LimitLine]:
    marks = F.array(*[F.lit(i / LIMIT_CELLS) for i in range(LIMIT_CELLS + 1)])
    known = [programs.select(F.lit(k).alias("_k"), F.col(c).cast("double").alias("_limit")) for k, c in enumerate(limits)]
    distinct = reduce(DataFrame.unionAll, known).filter("_limit IS NOT NULL").distinct()
    quantiles = F.percentile_approx("_limit", marks, F.lit(10 * LIMIT_CELLS))
    found = {r["_k"]: r for r in distinct.groupBy("_k").agg(quantiles.alias("q"), F.count(F.lit(1)).alias("n")).collect()}
    lines = []
    for k in range(len(limits)):
        borders = sorted(set(found[k]["q"])) if k in found else []
        n, runs = found[k]["n"] if k in found else 0, None
        if n > len(borders):
            own = distinct.filter(F.col("_k") == k)
            cell = count_upto(F.lit(borders), F.col("_limit"), len(borders), below=True)
            runs = own.groupBy(cell.alias("_cell")).agg(F.sort_array(F.collect_list("_limit")).alias("_limits"))
            # one row per cell, hence the unpartitioned window
            upto = F.sum(F.size("_limits")).over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
            runs = runs.withColumn("_before", upto - F.size("_limits"))
        lines.append(LimitLine(n, borders, runs))
    return lines


def _own_nodes(place: Column, n: int) -> Column:
    """The nodes over a place: one per level of a binary tree."""
    return F.array(*[F.shiftright(place, level) + F.lit(level * NODE) for level in range(max(1, n.bit_length()))])


def _nodes_from(place: Column, n: int) -> Column:
    """The few nodes that together cover this place and all behind it."""
    behind = [
        F.when(F.shiftright(place, level).bitwiseAND(F.lit(1)) == 0, F.shiftright(place, level) + F.lit(level * NODE + 1))
        for level in range(max(1, n.bit_length()))
    ]
    return F.array_compact(F.array(place, *behind))


def _loan_terms(df: DataFrame, price: str, income: str, digits: int | None) -> DataFrame:
    financed = F.col(price) * F.col("financed_pct") / 100
    monthly = F.col("yearly_rate") / 100 / 12
    part = F.col("financed") / F.col("months")
    out = df.withColumn("financed", financed)
    out = out.withColumns(
        {
            "down_payment": F.col(price) - F.col("financed"),
            "first_instalment": part + F.col("financed") * monthly,
            "last_instalment": part + part * monthly,
            "max_instalment": F.col(income) * INCOME_SHARE,
        }
    ).withColumn("approved", F.col("first_instalment") <= F.col("max_instalment"))
    if digits is None:
        return out
    money = ("financed", "down_payment", "first_instalment", "last_instalment", "max_instalment")
    return out.withColumns({c: F.round(c, digits) for c in money})


def loan_assignment(
    applications: DataFrame, programs: DataFrame, app_id: str, price: str, income: str, digits: int | None = 2
) -> DataFrame:
    """Programme, amounts and the income test per application (constant amortisation).

    The first programme by priority, equal ones by their terms, whose limits admit the application; an unknown price or income
    fits programmes without that limit only. Programmes may be of any number: prices and incomes become
    places on the lines of limits, and the best programme at or behind two places is a minimum over the nodes of a binary tree
    on either line. Programmes and pairs of places are listed under some log(n) x log(n) nodes, never beside each other.
    """
    offered = programs.filter("priority IS NOT NULL").select(F.struct("priority", *PROGRAM_TERMS).alias("_p"), "income_limit", "price_limit")
    # A programme without limits hides all that come after it.
    unlimited = F.col("income_limit").isNull() & F.col("price_limit").isNull()
    offered = offered.filter(F.coalesce(F.col("_p") <= offered.agg(F.min(F.when(unlimited, F.col("_p")))).scalar(), F.lit(True)))
    earned, paid = limit_lines(offered, ("income_limit", "price_limit"))
    ranked = paid.place(earned.place(offered, "income_limit", "_i"), "price_limit", "_c")
    nodes = ranked.select("_p", "_i", F.explode(_own_nodes(F.col("_c"), paid.n)).alias("_cn"))
    nodes = nodes.select("_p", "_cn", F.explode(_own_nodes(F.col("_i"), earned.n)).alias("_in"))
    best = nodes.groupBy("_in", "_cn").agg(F.min("_p").alias("_p"))
    asked = paid.place(earned.place(applications, income, "_i"), price, "_c")
    places = asked.select("_i", "_c").distinct()
    open_ = places.withColumn("_in", F.explode(_nodes_from(F.col("_i"), earned.n)))
    open_ = open_.withColumn("_cn", F.explode(_nodes_from(F.col("_c"), paid.n)))
    chosen = open_.join(best, ["_in", "_cn"]).groupBy("_i", "_c").agg(F.min("_p").alias("_p"))
    picked = [F.col(f"_p.{t}").alias(t) for t in PROGRAM_TERMS]
    out = asked.join(chosen, ["_i", "_c"], "left").select(*applications.columns, *picked)
    return _loan_terms(out, price, income, digits)


def derived_factor(base: DataFrame, extras: DataFrame, key: str, base_cost: str, extra_cost: str) -> DataFrame:
    """``(base + all extras) / base`` per key; no extras gives 1."""
    added = extras.groupBy(key).agg(F.sum(extra_cost).alias("extra_total"))
    out = base.join(added, key, "left").withColumn("extra_total", F.coalesce("extra_total", F.lit(0.0)))
    return out.withColumn("factor", F.try_divide(F.col(base_cost) + F.col("extra_total"), F.col(base_cost)))


def against_baseline(df: DataFrame, where: Column, cols: Sequence[str]) -> DataFrame:
    """Each measure divided by the baseline row's."""
    ratios = {f"{c}_vs_base": F.try_divide(F.col(c), joins.scalar_baseline(df, where, c)) for c in cols}
    return df.withColumns(ratios)


def project_cost(
    projects: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], base: str, area: str
) -> DataFrame:
    """Base cost times every dimension's factor times the area; an unmatched factor counts 1.

    ``dims`` maps a key column to its dimension and factor column.
    """
    out = projects
    product = F.col(base) * F.col(area)
    for key, (dim, factor) in dims.items():
        out = out.join(dim.select(key, factor), key, "left")
        product = product * F.coalesce(F.col(factor), F.lit(1.0))
    return out.withColumn("total_cost", product)


# fixed values: headers of the published files
EMPLOYMENT_SYNONYMS = {
    "period": ["competencia", "competência", "competenciamov", "competênciamov", "competenciadec", "competênciadec", "period"],
    "state": ["uf", "sigla_uf", "state"],
    "municipality": ["municipio", "município", "codigomunicipio", "municipality"],
    "section": ["secao_cnae", "seção", "secao", "section"],
    "code": ["subclasse_cnae", "subclasse", "cnaes20subclasse", "cnae20subclasse", "cnae2.0subclasse", "code"],
    "admitted": ["admitidos", "admissoes", "admissões", "admitted"],
    "dismissed": ["desligados", "desligamentos", "dismissed"],
    "balance": ["saldo", "saldomovimentacao", "saldomovimentação", "balance"],
    "mean_wage": ["salario_medio", "salariomedio", "saláriomédio", "salario", "salário", "valorsalariofixo", "valorsaláriofixo", "mean_wage"],
}


def employment_fact(df: DataFrame, states: DataFrame | None = None, digits: int | None = 2) -> DataFrame:
    """Movements of the construction sector summed by state and month, with the mean wage."""
    named = filters.sector_filter(columns.synonym_columns(df, EMPLOYMENT_SYNONYMS))
    if "state" not in named.columns and states is not None:
        named = joins.parent_code_lookup(named, "municipality", states, "state_code")
    period = F.col("period").cast("string")
    dated = named.withColumn("ref_date", period_to_date(F.substring(period, 1, 4), F.substring(period, 5, 2)))
    spec = {"admitted": "sum", "dismissed": "sum", "balance": "sum", "mean_wage": "mean"}
    out = stats.multi_measure(dated, ["state", "ref_date"], spec)
    if digits is None or "mean_wage" not in out.columns:
        return out
    return out.withColumn("mean_wage", F.round("mean_wage", digits))


# fixed values: headers of the published files
MATERIAL_SYNONYMS = {
    "code": ["codigo", "código", "codigo do insumo", "código do insumo", "codigo_sinapi", "código_sinapi", "code"],
    "description": ["descricao", "descrição", "descricao do insumo", "descrição do insumo", "description"],
    "unit": ["unidade", "unidade de medida", "un", "unit"],
    "price": ["preco", "preço", "preco mediano r$", "preço mediano r$", "preco mediano", "preço mediano", "preco unitario", "preço unitário", "valor", "price"],
    "kind": ["tipo_insumo", "tipo", "kind"],
    "category": ["classe", "category"],
}


def materials_fact(df: DataFrame, region: str = "BR", month: str = "2024-01") -> DataFrame:
    """Price list rows that are materials, with a typed unit price."""
    named = filters.category_filter(columns.synonym_columns(df, MATERIAL_SYNONYMS))
    return named.select(
        F.coalesce("description", F.col("code").cast("string")).alias("material"),
        F.lit(region).alias("region"),
        F.lit(f"{month}-01").cast("date").alias("ref_date"),
        "code",
        br_number(F.col("price").cast("string"), "comma_only").alias("unit_price"),
        "unit",
    )


# fixed values: headers of the published files
CLIMATE_SYNONYMS = {
    "station": ["CD_ESTACAO"],
    "station_name": ["DC_NOME"],
    "ref_date": ["DT_MEDICAO"],
    "hour": ["HR_MEDICAO"],
    "rain_mm": ["CHUVA"],
    "temp": ["TEM_INS"],
    "temp_max": ["TEM_MAX"],
    "temp_min": ["TEM_MIN"],
    "humidity": ["UMD_INS"],
    "wind": ["VEN_VEL"],
}


def climate_observations(df: DataFrame) -> DataFrame:
    """Station records with canonical names and typed measures."""
    named = columns.synonym_columns(df, CLIMATE_SYNONYMS)
    measures = ["rain_mm", "temp", "temp_max", "temp_min", "humidity", "wind"]
    typed = columns.coerce_numeric(named, measures)
    return typed.withColumn("ref_date", F.try_to_date("ref_date", "yyyy-MM-dd"))


def climate_fact(df: DataFrame) -> DataFrame:
    """Rain, rainy days and mean temperature per station and month."""
    month = F.trunc("ref_date", "month").alias("month")
    daily = climate_observations(df).groupBy("station", "ref_date").agg(
        F.sum("rain_mm").alias("rain_mm"), F.sum("temp").alias("_t"), F.count("temp").alias("_n")
    )
    return daily.groupBy("station", month).agg(
        F.sum("rain_mm").alias("rain_mm"),
        F.count_if(F.col("rain_mm") > 0).alias("rainy_days"),
        (F.sum("_t") / F.nullif(F.sum("_n"), F.lit(0))).alias("mean_temp"),
    )


# fixed values: wordings that announce a rate, tried in order
TRANSFER_TAX_PATTERNS = [
    r"ITBI.*?(\d+(?:,\d+)?)\s*%",
    r"transmiss[aã]o.*?(\d+(?:,\d+)?)\s*%",
    r"al[ií]quota.*?ITBI.*?(\d+(?:,\d+)?)\s*%",
    r"(\d+(?:,\d+)?)\s*%.*?transmiss[aã]o",
]
SERVICE_TAX_PATTERNS = [
    r"constru[çc][aã]o\s+civil.*?(\d+(?:,\d+)?)\s*%",
    r"ISS.*?constru[çc][aã]o.*?(\d+(?:,\d+)?)\s*%",
    r"servi[çc]os\s+de\s+constru[çc][aã]o.*?(\d+(?:,\d+)?)\s*%",
]


def extract_rate(text: Column, patterns: Sequence[str]) -> Column:
    """Percent announced by the first pattern that matches anywhere in the text (case-blind).

    Where every pattern names the percent sign, texts without one are not searched.
    """
    announced = F.when(F.contains(text, F.lit("%")), text) if all("%" in p for p in patterns) else text
    matches = [F.nullif(F.regexp_extract(announced, f"(?iu){p}", 1), F.lit("")) for p in patterns]
    return to_double(F.replace(F.coalesce(*matches), F.lit(","), F.lit(".")))


# fixed values: reference prices per state, and the default row
MATERIAL_LABELS = {
    "cimento": ("Cimento CP II 50kg", "KG"),
    "areia": ("Areia média m³", "M3"),
    "brita": ("Brita nº1 m³", "M3"),
    "aco": ("Aço CA-50 10mm", "KG"),
    "tijolo": ("Tijolo cerâmico", "UN"),
    "concreto": ("Concreto fck25 usinado", "M3"),
}
REFERENCE_PRICES = {
    "SP": {"cimento": 0.72, "areia": 120, "brita": 95, "aco": 6.80, "tijolo": 0.85, "concreto": 450},
    "RJ": {"cimento": 0.78, "areia": 135, "brita": 105, "aco": 7.10, "tijolo": 0.92, "concreto": 480},
    "MG": {"cimento": 0.68, "areia": 110, "brita": 90, "aco": 6.50, "tijolo": 0.78, "concreto": 420},
    "RS": {"cimento": 0.75, "areia": 125, "brita": 98, "aco": 6.90, "tijolo": 0.88, "concreto": 460},
    "PR": {"cimento": 0.70, "areia": 115, "brita": 92, "aco": 6.60, "tijolo": 0.82, "concreto": 440},
}
DEFAULT_PRICES = {"cimento": 0.73, "areia": 120, "brita": 95, "aco": 6.75, "tijolo": 0.85, "concreto": 450}


def reference_prices(places: DataFrame, state: str, prices: DataFrame, default: DataFrame) -> DataFrame:
    """Price of every default material per place: the state's own, else the default.

    ``prices`` is keyed by state and material, ``default`` by material.
    """
    own = prices.select(state, "material", F.col("price").alias("_own"))
    grid = joins.cross_product(places, default.select("material", F.col("price").alias("_default")))
    out = grid.join(own, [state, "material"], "left")
    return out.withColumns(
        {"price": F.coalesce("_own", "_default"), "is_default": F.col("_own").isNull()}
    ).drop("_own", "_default")


def price_tables(spark) -> tuple[DataFrame, DataFrame]:
    """The reference prices as a (state, material, price) table and the default (material, price) table."""
    own = [(s, MATERIAL_LABELS[m][0], float(p)) for s, row in REFERENCE_PRICES.items() for m, p in row.items()]
    default = [(MATERIAL_LABELS[m][0], MATERIAL_LABELS[m][1], float(p)) for m, p in DEFAULT_PRICES.items()]
    return (
        spark.createDataFrame(own, "state string, material string, price double"),
        spark.createDataFrame(default, "material string, unit string, price double"),
    )


def cost_panel(
    wide: DataFrame, date: str, ids: Sequence[str], regime: str, var: str = "cost_type", share_of: Sequence[str] = ()
) -> DataFrame:
    """Wide text table to a typed long panel with MoM and YoY per key, optionally with shares."""
    cols = [c for c in wide.columns if c not in (date, *ids)]
    long = wide.unpivot([F.col(date), *[F.col(c) for c in ids]], [F.col(c) for c in cols], var, "_text")
    typed = long.withColumn("value", br_number(F.col("_text"))).drop("_text").filter("value IS NOT NULL")
    out = windows.mom_yoy(typed, [*ids, var], date, "value", pad=False).withColumn("regime", F.lit(regime))
    if share_of:
        out = windows.share_of_total(out, share_of, "value", period_table=True)
    return out
