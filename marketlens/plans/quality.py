"""Quality report, its gate, cross-layer audit and the invisible-character scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import empty_to_null, parse_br_number
from marketlens.operators.aggregates import histogram, histogram_json
from marketlens.operators.ranking import ratio
from marketlens.schemas import QUALITY_SCHEMA, Thresholds


class QualityError(RuntimeError):
    """A gate found errors; the message lists them."""


def porte_histogram(silver: DataFrame) -> DataFrame:
    return histogram(silver, F.coalesce("porte_empresa", F.lit("Sem porte")), "porte", "total")


def _rows(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _check(name: str, value: Column, status: Column | str = "ok") -> Column:
    status = F.lit(status) if isinstance(status, str) else status
    return F.struct(
        F.lit(name).alias("validacao"), value.cast("string").alias("valor"), status.alias("status"), F.lit("").alias("detalhe")
    )


# The names of the checks in `quality_checks`.


def quality_checks(gold: DataFrame, funnel: DataFrame, matched: DataFrame, status: DataFrame, style: str = "br") -> DataFrame:
    """The report, one row per check.

    `funnel` is one row of `ingest_funnel`, `matched` the companies kept in bronze and
    `status` the whole-file rows of `status_histogram`. The gold table is read once for all
    of its counts."""

    def percent(missing: Column) -> Column:
        return F.coalesce(ratio(F.lit(100.0) * F.count_if(missing), F.count(F.lit(1))), F.lit(0.0))

    totals = gold.agg(
        F.count(F.lit(1)).alias("total"),
        percent(empty_to_null("cnae_principal").isNull()).alias("sem_cnae"),
        percent(empty_to_null("municipio").isNull()).alias("sem_municipio"),
        percent(F.col("populacao").isNull() | F.col("pib_per_capita").isNull()).alias("sem_pib"),
        percent(empty_to_null("descricao_cnae").isNull()).alias("sem_descricao"),
        (F.count(F.lit(1)) - F.count_distinct("cnpj_completo")).alias("duplicados"),
    )
    porte = histogram_json(porte_histogram(gold), "porte", "total")
    situacao = histogram_json(status, "situacao_cadastral", "n")
    refused = empty_to_null("capital_social").isNotNull() & parse_br_number("capital_social", style).isNull()
    read = funnel.agg(F.first(F.struct("lidos", "na_uf", "ativos", "empresas_unicas")))
    facts = totals.withColumns(
        {
            "f": read.scalar(),
            "emp": matched.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(refused).alias("recusados"))).scalar(),
            "porte": porte.scalar(),
            "situacao": situacao.scalar(),
        }
    )

    def percent_row(name: str, column: str) -> Column:
        return _check(name, F.round(column, 2), F.when(F.col(column) > 0, "atencao").otherwise("ok"))

    return _rows(
        facts,
        [
            _check("registros_lidos_estabelecimentos", F.col("f.lidos")),
            _check("estabelecimentos_sc", F.col("f.na_uf")),
            _check("estabelecimentos_ativos_sc", F.col("f.ativos")),
            _check("cnpj_basico_unicos_sc", F.col("f.empresas_unicas")),
            _check("empresas_cruzadas_com_sucesso", F.col("emp.n")),
            _check("capital_social_recusado", F.col("emp.recusados"), F.when(F.col("emp.recusados") > 0, "atencao").otherwise("ok")),
            _check("total_gold_empresas_ativas_sc", F.col("total")),
            percent_row("percentual_empresas_sem_cnae", "sem_cnae"),
            percent_row("percentual_empresas_sem_municipio", "sem_municipio"),
            percent_row("percentual_municipios_sem_match_pib_populacao", "sem_pib"),
            percent_row("percentual_cnaes_sem_descricao", "sem_descricao"),
            _check(
                "duplicidade_cnpj_completo",
                F.col("duplicados"),
                F.when(F.col("duplicados") > 0, "erro").otherwise("ok"),
            ),
            _check("distribuicao_porte", F.col("porte")),
            _check("distribuicao_situacao_cadastral", F.col("situacao")),
        ],
    ).select(*QUALITY_SCHEMA.fieldNames())


def validation_summary(quality: DataFrame) -> DataFrame:
    return histogram(quality, "status", "status")


def offending(quality: DataFrame) -> DataFrame:
    """Errors and warnings."""
    return quality.filter(F.col("status").isin("erro", "atencao"))


def validate(quality: DataFrame) -> DataFrame:
    """Raise when the report (a dozen rows) holds an error; else the errors and warnings."""
    errors = quality.filter(F.col("status") == "erro").collect()
    if errors:
        raise QualityError("; ".join(f"{r.validacao}: {r.valor}" for r in errors))
    return offending(quality)


def audit_layers(silver_estab: DataFrame, silver_emp: DataFrame, gold: DataFrame, rank_m: DataFrame, rank_c: DataFrame) -> DataFrame:
    """Row and key counts of every layer, side by side in long form; one aggregate a table."""

    def counts(df: DataFrame, layer: str, metrics: dict[str, Column]) -> DataFrame:
        row = df.agg(*[m.cast("long").alias(name) for name, m in metrics.items()])
        return _rows(
            row,
            [F.struct(F.lit(layer).alias("camada"), F.lit(n).alias("metrica"), F.col(n).alias("valor")) for n in metrics],
        )

    rows = F.count(F.lit(1))
    parts = [
        counts(silver_estab, "silver", {"silver_estabelecimentos": rows, "silver_cnpjs": F.count_distinct("cnpj_basico")}),
        counts(silver_emp, "silver", {"silver_empresas": rows}),
        counts(
            gold,
            "gold",
            {
                "estabelecimentos_ativos": rows,
                "cnpj_basico_unicos": F.count_distinct("cnpj_basico"),
                "municipios_distintos": F.count_distinct("municipio"),
                "cnaes_distintos": F.count_distinct("cnae_fiscal_principal"),
            },
        ),
        counts(rank_m, "gold", {"ranking_municipios": rows}),
        counts(rank_c, "gold", {"ranking_cnaes": rows}),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def audit_blockers(
    audit: DataFrame, missing_parts: DataFrame, matches: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """The six rules of the audit. A match percentage that was never measured counts as 100."""

    def layer(metric: str) -> Column:
        return F.max(F.when(F.col("metrica") == metric, F.col("valor")))

    def match(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("dimensao") == name, F.col("percentual_match"))), F.lit(100.0))

    missing = missing_parts.agg(
        F.struct(
            F.count_if(F.col("tipo") == "estabelecimentos").alias("estab"), F.count_if(F.col("tipo") == "empresas").alias("emp")
        )
    )
    match_row = matches.agg(F.struct(match("empresas").alias("emp"), match("cnaes").alias("cnae")))
    facts = audit.agg(
        layer("estabelecimentos_ativos").alias("ativos"), layer("municipios_distintos").alias("municipios")
    ).withColumns({"faltam": missing.scalar(), "match": match_row.scalar()})
    return _rows(
        facts,
        [
            rule("partes_estabelecimentos", F.col("faltam.estab"), 0, F.col("faltam.estab") > 0),
            rule("partes_empresas", F.col("faltam.emp"), 0, F.col("faltam.emp") > 0),
            rule("minimo_ativos", F.col("ativos"), thresholds.min_ativos, F.col("ativos") < thresholds.min_ativos),
            rule(
                "minimo_municipios",
                F.col("municipios"),
                thresholds.min_municipios,
                F.col("municipios") < thresholds.min_municipios,
            ),
            rule(
                "match_empresas",
                F.col("match.emp"),
                thresholds.min_match_empresas,
                F.col("match.emp") < thresholds.min_match_empresas,
            ),
            rule(
                "match_cnaes",
                F.col("match.cnae"),
                thresholds.min_match_cnaes,
                F.col("match.cnae") < thresholds.min_match_cnaes,
            ),
        ],
    )


def rule(name: str, value: Column, limit, blocked: Column) -> Column:
    """One row of a rule table."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return F.struct(
        F.lit(name).alias("regra"),
        value.cast("double").alias("valor"),
        limit.cast("double").alias("limite"),
        F.coalesce(blocked, F.lit(True)).alias("bloqueado"),
    )


# Characters that must not occur in text, with their names.
INVISIBLE = {
    "\u00a0": "U+00A0 non-breaking space",
    "\u200b": "U+200B zero-width space",
    "\u200c": "U+200C zero-width non-joiner",
    "\u200d": "U+200D zero-width joiner",
    "\ufeff": "U+FEFF BOM",
}
_LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_CONTROL = r"[\x00-\x1f&&[^\t\n\x0b\f\r\x1c-\x1e]]"


def scan_invisible(df: DataFrame, key: str, text: str) -> DataFrame:
    """Invisible characters (one row per line and character) and control characters (one
    row each, with their column) in a text column. Only texts and lines that hold one are
    taken apart."""

    def holds_any(c: str) -> Column:
        # Byte searches and one ASCII class: far cheaper than a class over all of Unicode.
        hit = F.col(c).rlike(_CONTROL)
        for ch in INVISIBLE:
            hit = hit | F.col(c).contains(ch)
        return hit

    lines = df.filter(holds_any(text)).select(key, F.posexplode(F.split(text, _LINE_BREAK)).alias("line_no", "line"))
    found = [
        F.when(F.col("line").contains(ch), F.struct(F.lit(None).cast("long").alias("col"), F.lit(label).alias("label")))
        for ch, label in INVISIBLE.items()
    ]
    chars = F.split("line", "")
    controls = F.when(
        F.col("line").rlike(_CONTROL),
        F.filter(
            F.transform(
                chars,
                lambda ch, i: F.when(
                    ch.rlike(_CONTROL),
                    F.struct(
                        (i + F.lit(1)).cast("long").alias("col"),
                        F.concat(F.lit("control char U+"), F.lpad(F.hex(F.ascii(ch)), 4, "0")).alias("label"),
                    ),
                ),
            ),
            lambda hit: hit.isNotNull(),
        ),
    )
    hits = F.concat(F.array_compact(F.array(*found)), F.coalesce(controls, F.array()))
    return (
        lines.filter(holds_any("line"))
        .select(key, (F.col("line_no") + 1).cast("long").alias("line_no"), F.explode(hits).alias("hit"))
        .select(key, "line_no", "hit.col", "hit.label")
    )


def marked(metrics: DataFrame, marker: str = "sintetico") -> DataFrame:
    """The metrics (a row each) whose value mentions sample data."""
    return metrics.filter(F.lower("value").contains(marker))


def has_marker(metrics: DataFrame, marker: str = "sintetico") -> bool:
    """Whether any value of the metrics table mentions sample data."""
    return not marked(metrics, marker).isEmpty()
