"""The registry's relations laid over TPC-H-like tables, for queries and benchmarks.

The only module that knows those tables. Spark derives every relation from them, so the
work of a query grows with the data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.text import normalize_text
from marketlens.operators.keys import distinct_keys
from marketlens.plans import gold
from marketlens.plans.bronze import bronze_companies, bronze_simples, filter_target
from marketlens.plans.market_index import MarketIndex
from marketlens.plans.silver import build_silver
from marketlens.session import broadcast_if_small, durable, scratch_path, tune

TARGET_UF = "AS"
AS_OF = "2024-01-01"


def _code(n: Column, width: int) -> Column:
    text = n.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _unmatched(key: Column, when: Column) -> Column:
    """A key that nothing refers to where `when` holds; no row is left out for it."""
    return F.concat(F.when(when, F.lit("X")).otherwise(F.lit("")), key)


def _amount(x: Column) -> Column:
    return F.replace(x.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


@dataclass(frozen=True)
class Views:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def estab(self) -> DataFrame:
        """Establishments as read: states with stray blanks and case, invalid dates."""
        places = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), F.substring("r_name", 1, 2).alias("state"))
        )
        places = broadcast_if_small(places)
        line = F.col("l_linenumber")
        status = F.when(F.col("l_returnflag") == "A", "02").when(F.col("l_returnflag") == "N", "2").otherwise("08")
        return (
            self.table("lineitem")
            .join(places, "l_suppkey")
            .select(
                _code(F.col("l_orderkey"), 8).alias("cnpj_basico"),
                _code(line, 4).alias("cnpj_ordem"),
                _code(F.col("l_partkey") % 100, 2).alias("cnpj_dv"),
                F.when(line != 3, F.concat(F.lit("Loja "), F.col("l_suppkey").cast("string"))).alias("nome_fantasia"),
                status.alias("situacao_cadastral"),
                F.when(line == 7, "00000000").otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("data_inicio_atividade"),
                _code(F.col("l_partkey") % 331, 7).alias("cnae_fiscal_principal"),
                F.when(line % 2 == 0, F.concat(F.lit(" "), F.lower("state"), F.lit(" "))).otherwise(F.col("state")).alias("uf"),
                F.col("l_suppkey").cast("string").alias("municipio"),
                F.concat(F.lit("Estabelecimentos"), (F.col("l_orderkey") % 10).cast("string"), F.lit(".zip")).alias("source"),
                (F.col("l_orderkey") % 50).alias("dirt"),
            )
        )

    @cached_property
    def dirty_estab(self) -> DataFrame:
        """Establishments with damaged state codes in a few percent of the rows."""
        uf = F.when(F.col("dirt") == 0, "").when(F.col("dirt") == 1, "9X").when(F.col("dirt") == 2, "ABC").otherwise(F.col("uf"))
        return self.estab.withColumn("uf", uf)

    @cached_property
    def emp(self) -> DataFrame:
        key = F.col("o_orderkey")
        size = F.substring("o_orderpriority", 1, 1)
        porte = F.when(size == "1", "01").when(size == "2", "03").when(size == "3", "05").when(size == "4", "00").otherwise("")
        # 2^80, 2^100 and more than a double holds, besides what isn't a number
        capital = (
            F.when(key % 19 == 0, "")
            .when(key % 23 == 0, "abc")
            .when(key % 997 == 1, str(1 << 80))
            .when(key % 997 == 2, str(1 << 100))
            .when(key % 997 == 3, "1e999")
            .otherwise(_amount(F.col("o_totalprice")))
        )
        return self.table("orders").select(
            _code(key, 8).alias("cnpj_basico"),
            F.concat(F.lit("Co "), key.cast("string")).alias("razao_social"),
            F.col("o_orderstatus").alias("natureza_juridica"),
            (F.col("o_custkey") % 60).cast("string").alias("qualificacao_responsavel"),
            capital.alias("capital_social"),
            porte.alias("porte_empresa"),
            F.lit(None).cast("string").alias("ente_federativo_responsavel"),
            F.concat(F.lit("Empresas"), (key % 9).cast("string"), F.lit(".zip")).alias("source"),
        )

    @cached_property
    def municipios(self) -> DataFrame:
        name = F.replace(F.col("s_name"), F.lit("Supplier"), F.lit("São  José"))
        return self.table("supplier").select(
            _unmatched(F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 20 == 0).alias("codigo_municipio_receita"),
            name.alias("nome_municipio_receita"),
            normalize_text(name).alias("municipio_norm"),
        )

    @cached_property
    def cnaes(self) -> DataFrame:
        code = F.col("p_partkey") % 331
        return self.table("part").select(
            _unmatched(_code(code, 7), code % 50 == 0).alias("cnae"), F.col("p_name").alias("descricao_cnae")
        )

    @cached_property
    def naturezas(self) -> DataFrame:
        return self.table("orders").select(
            _unmatched(F.col("o_orderstatus"), F.col("o_orderstatus") == "P").alias("natureza_juridica"),
            F.concat(F.lit("Natureza "), F.col("o_orderstatus")).alias("descricao_natureza_juridica"),
        ).distinct()

    @cached_property
    def simples(self) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        yes_no = lambda c: F.when(c, "S").otherwise("N")
        rows = self.table("orders").select(
            _unmatched(_code(key, 8), key % 3 == 0).alias("cnpj_basico"),
            yes_no(cust % 2 == 0).alias("opcao_simples"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("data_opcao_simples"),
            F.lit(None).cast("string").alias("data_exclusao_simples"),
            F.when(cust % 7 != 0, yes_no(cust % 5 == 0)).alias("opcao_mei"),
            F.lit(None).cast("string").alias("data_opcao_mei"),
            F.lit(None).cast("string").alias("data_exclusao_mei"),
            (key % 4).alias("r"),
        )
        again = rows.filter("r = 1").withColumn("opcao_simples", yes_no(F.col("opcao_simples") == "N"))
        return rows.unionByName(again).drop("r")

    @property
    def _places(self) -> DataFrame:
        norm = normalize_text(F.replace(F.col("s_name"), F.lit("Supplier"), F.lit(" sao josé")))
        return self.table("supplier").withColumn("municipio_norm", norm)

    @cached_property
    def indicators(self) -> DataFrame:
        key = F.col("s_suppkey")
        longer = F.when(key % 7 == 0, F.lit("3457")).otherwise(F.lit(""))  # six decimals
        return self._places.select(
            F.concat(F.when(key % 10 == 3, F.lit("X ")).otherwise(F.lit("")), "municipio_norm").alias("municipio_norm"),
            (F.lit(4200000) + F.col("s_suppkey")).cast("string").alias("codigo_municipio_ibge"),
            F.lit("").alias("cnae_principal"),
            (F.lit(1000) + F.col("s_suppkey") * 37).cast("string").alias("populacao"),
            F.concat(_amount(F.col("s_acctbal")), longer).alias("pib_per_capita"),
        )

    @cached_property
    def pib(self) -> DataFrame:
        """Two yearly rows per code; the later one counts."""
        code = F.lit(4200000) + F.floor(F.col("s_suppkey") / 2)
        return self._places.select(
            code.cast("string").alias("codigo_municipio_ibge"),
            "municipio_norm",
            _amount(F.col("s_acctbal")).alias("pib_per_capita"),
            F.col("s_suppkey").alias("seq"),
        )

    @cached_property
    def pop(self) -> DataFrame:
        code = F.lit(4200000) + F.floor(F.col("s_suppkey") / 3) * 2
        return self._places.select(
            _unmatched(code.cast("string"), F.col("s_suppkey") % 3 == 0).alias("codigo_municipio_ibge"),
            F.concat(F.lit("POP "), "municipio_norm").alias("municipio_norm"),
            (F.lit(1000) + F.col("s_suppkey") * 37).cast("string").alias("populacao"),
            F.col("s_suppkey").alias("seq"),
        )

    @cached_property
    def active(self) -> DataFrame:
        return filter_target(self.estab, TARGET_UF)

    @cached_property
    def active_keys(self) -> DataFrame:
        return distinct_keys(self.active, "cnpj_basico")

    @cached_property
    def active_companies(self) -> DataFrame:
        return bronze_companies(self.emp, self.active_keys)

    @cached_property
    def active_simples(self) -> DataFrame:
        return bronze_simples(self.simples, self.active_keys)

    @cached_property
    def silver_plan(self) -> DataFrame:
        return build_silver(
            self.active,
            self.active_companies,
            self.municipios,
            self.cnaes,
            self.naturezas,
            self.active_simples,
            self.indicators,
            AS_OF,
        )

    @cached_property
    def silver(self) -> DataFrame:
        """The wide table, stored by the first query that needs it: gold tables and questions
        read a stored table, as in the batch build."""
        return durable(self.silver_plan)

    @property
    def market(self) -> DataFrame:
        """The wide table for a question that reads it once: the stored one if a query has stored it, else
        its plan, of which only the columns asked for are computed."""
        return self.__dict__.get("silver", self.silver_plan)

    @cached_property
    def market_states(self) -> DataFrame:
        """Partial states of the wide table, as the batch build stores them."""
        return gold.market_states(self.silver)

    @cached_property
    def market_index(self) -> MarketIndex:
        return MarketIndex.build(self.silver, scratch_path(self.spark))

    @cached_property
    def file_names(self) -> DataFrame:
        """A name for each part, most of them of a known kind."""
        key = F.col("p_partkey")
        # One name pattern per remainder of the part key.
        patterns = [
            "K3241.K03200Y0.D%.ESTABELE",
            "K3241.K03200Y0.D%.EMPRECSV",
            "F.K03200.D%.CNAECSV",
            "F.K03200.D%.MUNICCSV",
            "F.K03200.D%.NATJUCSV",
            "F.K03200.D%.MOTICSV",
            "F.K03200.W.SIMPLES.CSV.D%",
            "PIB dos Municipios %.csv",
            "população_%.csv",
            "nat_jurid_%.csv",
            "dados.est/parte%.csv",
            "leia-me %.txt",
        ]
        pattern = F.element_at(F.array(*[F.lit(p) for p in patterns]), (key % len(patterns) + 1).cast("int"))
        return self.table("part").select(
            F.concat(F.replace(pattern, F.lit("%"), key.cast("string"))).alias("label")
        )

    @cached_property
    def source_names(self) -> DataFrame:
        """All sources of a dump, also such as hold no rows."""
        part = (F.col("o_orderkey") % 10).cast("string")
        kinds = F.explode(F.array(F.lit("Estabelecimentos"), F.lit("Empresas"))).alias("kind")
        names = self.table("orders").select(part.alias("part"), kinds)
        return names.select(F.concat("kind", "part", F.lit(".zip")).alias("source")).distinct()

    def catalog_of(self, estab: DataFrame) -> DataFrame:
        """Sources of the two mandatory kinds, as a catalogue; `estab` is any table with the
        sources of the establishments."""
        kinds = {"estabelecimentos": estab, "empresas": self.emp}
        parts = [df.select(F.lit(kind).alias("kind"), F.col("source").alias("label")).distinct() for kind, df in kinds.items()]
        return parts[0].unionByName(parts[1])


_VIEWS: dict[tuple[str, str], Views] = {}


def views(spark: SparkSession, sf_dir: str) -> Views:
    """The relations of one data folder; plans and size checks are made once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VIEWS:
        _VIEWS[key] = Views(tune(spark), sf_dir)
    return _VIEWS[key]


def forget_views() -> None:
    """Describe every relation anew from now on, for instance after the folder's data changed."""
    _VIEWS.clear()
