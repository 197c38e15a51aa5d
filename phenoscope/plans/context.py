"""Typed event tables for one data folder: raw stand-in extracts → cleaned
events.  Each table is planned when it is first asked for, so a query pays for the
extracts that it reads."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.extract import extract_diagnoses, extract_labs, extract_medications
from ..session import stored
from ..sources import standin


class Raw:
    """The raw extracts by the file stem the original loader used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._of = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, stem: str) -> DataFrame:
        if stem not in self._made:
            self._made[stem] = standin.RAW_TABLES[stem](*self._of)
        return self._made[stem]


class Events:
    """The cleaned events of the four raw extracts, ``raw[stem]``."""

    def __init__(self, raw: Raw | dict[str, DataFrame], on_error: str = "fail"):
        self.raw, self._on_error = raw, on_error

    @cached_property
    def dx(self) -> DataFrame:
        return extract_diagnoses(self.raw["encounter_INPUT"], self.raw["encounter_dx_INPUT"], on_error=self._on_error)

    @cached_property
    def med(self) -> DataFrame:
        return extract_medications(self.raw["medication_orders_INPUT"], on_error=self._on_error)

    @cached_property
    def lab(self) -> DataFrame:
        return extract_labs(self.raw["lab_results_INPUT"], on_error=self._on_error)


def load_events(spark: SparkSession, sf_dir: str, on_error: str = "fail") -> Events:
    return Events(Raw(spark, sf_dir), on_error)


class StoredEvents(Events):
    """The cleaned events, each table extracted and stored once when it is first asked for;
    of the instants only those of medication orders, which alone are compared."""

    @cached_property
    def dx(self) -> DataFrame:
        return stored(super().dx.drop("ts"), "dx-events")

    @cached_property
    def med(self) -> DataFrame:
        return stored(super().med, "med-events")

    @cached_property
    def lab(self) -> DataFrame:
        return stored(super().lab.drop("ts"), "lab-events")


def stored_events(spark: SparkSession, sf_dir: str, on_error: str = "fail") -> StoredEvents:
    return StoredEvents(Raw(spark, sf_dir), on_error)
