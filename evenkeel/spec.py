"""Column roles, dataset descriptions and shared defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Default thresholds of the checks. All comparisons are strict.
DP_THRESHOLD = 0.1
EO_THRESHOLD = 0.05
DI_THRESHOLD = 0.8
NULL_THRESHOLD = 0.1
LABEL_THRESHOLD = 0.5
SEED = 42


class ValidationError(ValueError):
    """A table failed a mandatory check."""


class EmptyInputError(ValidationError):
    """A table holds no columns or no usable rows."""


def parse_features(text: str | Sequence[str]) -> list[str]:
    """Turn ``"sex, age"`` into ``["sex", "age"]``; blanks are dropped."""
    parts = text.split(",") if isinstance(text, str) else list(text)
    names = [p.strip() for p in parts if p.strip()]
    if not names:
        raise ValidationError("the list of sensitive features is empty")
    return names


@dataclass(frozen=True)
class ColumnRoles:
    """What each column of a table is for."""

    target: str
    sensitive: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name in ("sensitive", "numeric", "categorical"):
            object.__setattr__(self, name, tuple(getattr(self, name)))

    @property
    def essential(self) -> list[str]:
        return [self.target, *self.sensitive, *self.numeric, *self.categorical]


@dataclass(frozen=True)
class DatasetSpec:
    """Everything a flow needs to know about one kind of table.

    ``roles`` may be left out, in which case features are inferred from the
    column types. ``key`` names columns that together identify a row; without
    it rows are identified by their content. ``schema`` are the types of the
    columns in files, by name; without it types are inferred.
    """

    target: str
    sensitive: tuple[str, ...]
    roles: ColumnRoles | None = None
    expected: tuple[str, ...] = ()
    mandatory: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    recodes: Mapping[str, Mapping] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    sep: str = ","
    encoding: str = "UTF-8"
    remainder: str = "passthrough"
    scale: bool = False
    category_form: str = "columns"
    null_threshold: float = NULL_THRESHOLD
    dp_threshold: float = DP_THRESHOLD
    eo_threshold: float = EO_THRESHOLD
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = SEED
    schema: T.StructType | None = None

    @property
    def required(self) -> list[str]:
        listed = list(self.mandatory) or [self.target, *self.sensitive]
        essential = self.roles.essential if self.roles else []
        return list(dict.fromkeys([*listed, *essential, *self.key]))


def _schema(text: Sequence[str] = (), whole: Sequence[str] = (), real: Sequence[str] = ()) -> T.StructType:
    kinds = ((text, T.StringType()), (whole, T.LongType()), (real, T.DoubleType()))
    return T.StructType([T.StructField(n, kind) for names, kind in kinds for n in names])


# Layouts of the three known kinds of input table.
TOY = DatasetSpec(target="target", sensitive=("sensitive_attr",))

LABOUR_MARKET = DatasetSpec(
    target="ABGANG",
    sensitive=("Geschlecht",),
    roles=ColumnRoles(
        target="ABGANG",
        sensitive=("Geschlecht",),
        numeric=("RGSCode", "DS_VWD"),
        categorical=("Verweildauer", "Altersgruppe"),
    ),
    expected=("Datum", "RGSCode", "RGSName", "Geschlecht", "Verweildauer", "Altersgruppe", "ABGANG", "DS_VWD"),
    mandatory=("RGSCode", "Geschlecht", "Verweildauer", "Altersgruppe", "ABGANG", "DS_VWD"),
    drop=("Datum", "RGSName"),
    recodes={"Geschlecht": {"Männer": 1, "Frauen": 2}},
    sep=";",
    encoding="latin1",
    schema=_schema(
        text=("Datum", "RGSName", "Geschlecht", "Verweildauer", "Altersgruppe"), whole=("RGSCode", "ABGANG"), real=("DS_VWD",)),
)

EUROSTAT = DatasetSpec(
    target="OBS_VALUE",
    sensitive=("sex",),
    roles=ColumnRoles(
        target="OBS_VALUE",
        sensitive=("sex",),
        numeric=("TIME_PERIOD",),
        categorical=("freq", "age", "unit", "geo"),
    ),
    expected=(
        "DATAFLOW", "LAST UPDATE", "freq", "sex", "age", "unit", "geo",
        "TIME_PERIOD", "OBS_VALUE", "OBS_FLAG", "CONF_STATUS",
    ),
    mandatory=("OBS_VALUE", "sex", "TIME_PERIOD", "freq", "age", "unit", "geo"),
    drop=("DATAFLOW", "LAST UPDATE", "OBS_FLAG", "CONF_STATUS"),
    remainder="drop",
    schema=_schema(
        text=("DATAFLOW", "LAST UPDATE", "freq", "sex", "age", "unit", "geo", "OBS_FLAG", "CONF_STATUS"),
        whole=("TIME_PERIOD",), real=("OBS_VALUE",)),
)
