"""The dimension of courts that rates by population and place need. Pass a table of your own for other regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Court, jurisdiction, population (estimates), latitude, longitude, locality.
COURTS = (
    ("Zhovtnevyi", "Mariupol – Zhovtnevyi/Tsentralnyi district", 130_000, 47.097, 37.543, "Mariupol"),
    ("Primorskii", "Mariupol – Prymorskyi district", 90_000, 47.097, 37.543, "Mariupol"),
    ("Ordzhonikidzevskii", "Mariupol – Ordzhonikidzevskyi/Livoberezhnyi district", 110_000, 47.097, 37.543, "Mariupol"),
    ("Ilichevskii", "Mariupol – Illichivskyi/Kalmiuskyi district", 95_000, 47.097, 37.543, "Mariupol"),
    ("Voroshilovskii", "Donetsk – Voroshylovskyi district", 90_000, 48.003, 37.805, "Donetsk"),
    ("Kirovskii", "Donetsk – Kirovskyi district", 170_000, 48.003, 37.805, "Donetsk"),
    ("Budennovskii", "Donetsk – Budonnivskyi district", 100_000, 48.003, 37.805, "Donetsk"),
    ("Gornyatskii", "Makiivka – Hirnytskyi district", 85_000, 48.048, 37.926, "Makiivka"),
    ("Tsentralno-Gorodskoi", "Makiivka – Tsentralno-Miskyi district", 85_000, 48.048, 37.926, "Makiivka"),
    ("Khartsyzskii", "Khartsyzk (city council area)", 92_000, 48.033, 38.147, "Khartsyzk"),
    ("Enakievskii", "Yenakiieve (city council area)", 103_000, 48.232, 38.205, "Yenakiieve"),
    ("Gorlovskii", "Horlivka (city)", 240_000, 48.334, 38.093, "Horlivka"),
    ("Yasinovatskii", "Yasynuvata (city + raion)", 57_000, 48.128, 37.855, "Yasynuvata"),
    ("Volnovakhskii", "Volnovakha raion", 80_000, 47.601, 37.494, "Volnovakha"),
    ("Amvrosievskii", "Amvrosiivka raion", 44_000, 47.795, 38.478, "Amvrosiivka"),
    ("Telmanovskii", "Telmanove/Boikivske raion", 25_000, 47.410, 38.098, "Telmanove"),
    ("Starobeshevskii", "Starobesheve raion", 49_000, 47.752, 38.028, "Starobesheve"),
    ("Novoazovskii", "Novoazovsk raion", 33_000, 47.111, 38.083, "Novoazovsk"),
    ("Volodarskii", "Volodarske/Nikolske raion", 27_000, 47.187, 37.205, "Nikolske"),
    ("Debaltsevskii", "Debaltseve (city)", 25_000, 48.339, 38.406, "Debaltseve"),
    ("Marinskii", "Marinka raion", 84_000, 47.940, 37.503, "Marinka"),
    ("Pershotravnevyi", "Pershotravnevyi/Manhush raion", 25_000, 47.056, 37.303, "Manhush"),
)


def courts(spark: SparkSession) -> DataFrame:
    """SRC-11: ``court, jurisdiction, population, lat, lon, locality, ord``."""
    rows = [(*row, i) for i, row in enumerate(COURTS)]
    return spark.createDataFrame(rows, "court string, jurisdiction string, population long, lat double, lon double, locality string, ord long")
