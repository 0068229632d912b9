"""Declarative dataset catalog."""

from __future__ import annotations

from dataclasses import dataclass, replace

YEAR, YEAR_MONTH, NONE, MERGE = "YEAR", "YEAR_MONTH", "NONE", "MERGE"
PARTITION_COLUMN = {YEAR: "year", YEAR_MONTH: "year_month"}


@dataclass(frozen=True)
class DatasetSpec:
    """Roles and layout of one stored dataset."""

    name: str
    path: str
    granularity: str = NONE
    partition_field: str | None = None
    sort_fields: tuple[str, ...] = ()
    frequency: str = "daily"
    batch_strategy: str = "by_date_range"
    batch_size: int = 100
    keys: tuple[str, ...] = ()

    @property
    def partition_by(self) -> list[str]:
        column = PARTITION_COLUMN.get(self.granularity)
        return [column] if column else []

    def located(self, root: str) -> "DatasetSpec":
        """Same dataset under a root folder."""
        return replace(self, path=f"{root.rstrip('/')}/{self.path}")


# fixed values: name, path, granularity, partition field, sort fields, update
# frequency, batch strategy, batch size
_TABLE = """
daily               daily/daily_hfq                     YEAR        trade_date  ts_code_id,trade_date_int             daily    by_stock       50
daily_basic         daily/daily_basic                   YEAR        trade_date  ts_code_id,trade_date_int             daily    by_stock       50
moneyflow           daily/moneyflow                     YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
moneyflow_ths       daily/moneyflow_ths                 YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
moneyflow_dc        daily/moneyflow_dc                  YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
moneyflow_ind_dc    daily/moneyflow_ind_dc              YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
moneyflow_mkt_dc    daily/moneyflow_mkt_dc              YEAR        trade_date  trade_date_int                        daily    by_date        100
moneyflow_cnt_ths   daily/moneyflow_cnt_ths             YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
moneyflow_ind_ths   daily/moneyflow_ind_ths             YEAR        trade_date  ts_code_id,trade_date_int             daily    by_date        100
block_trade         events/block_trade                  YEAR_MONTH  trade_date  year_month,ts_code_id,trade_date_int  daily    by_date        100
cyq_chips           market_structure/cyq_chips          YEAR        trade_date  year,ts_code_id,trade_date_int        daily    by_stock       50
cyq_perf            market_structure/cyq_perf           YEAR        trade_date  year,ts_code_id,trade_date_int        daily    by_date        100
stk_surv            research/stk_surv                   YEAR_MONTH  ann_date    year_month,ts_code_id,ann_date_int    daily    by_date        100
stk_factor          daily/stk_factor                    YEAR        trade_date  ts_code_id,trade_date_int             daily    by_stock       50
stk_factor_pro      daily/stk_factor_pro                YEAR        trade_date  ts_code_id,trade_date_int             daily    by_stock       50
forecast            events/forecast.parquet             NONE        ann_date    ts_code_id,ann_date_int               daily    by_date        100
express             events/express.parquet              NONE        ann_date    ts_code_id,ann_date_int               daily    by_date        100
top10_holders       holders/top10_holders.parquet       NONE        ann_date    ts_code_id                            weekly   by_stock       50
top10_floatholders  holders/top10_floatholders.parquet  NONE        ann_date    ts_code_id                            weekly   by_stock       50
pledge_stat         holders/pledge_stat.parquet         NONE        end_date    ts_code_id,end_date_int               daily    by_stock       50
repurchase          holders/repurchase.parquet          NONE        ann_date    ts_code_id                            daily    by_date        100
share_float         holders/share_float.parquet         NONE        ann_date    ts_code_id                            daily    by_date        100
stk_holdertrade     holders/stk_holdertrade.parquet     NONE        ann_date    ts_code_id                            daily    by_stock       50
stk_managers        holders/stk_managers.parquet        NONE        ann_date    ts_code_id,ann_date_int               weekly   by_stock       50
stk_rewards         holders/stk_rewards.parquet         NONE        ann_date    ts_code_id                            weekly   by_stock       50
income              financials/income.parquet           NONE        end_date    ts_code_id                            daily    by_period      30
balancesheet        financials/balancesheet.parquet     NONE        end_date    ts_code_id                            daily    by_period      30
cashflow            financials/cashflow.parquet         NONE        end_date    ts_code_id                            daily    by_period      30
fina_indicator      financials/fina_indicator.parquet   NONE        ann_date    ts_code_id                            daily    by_period      30
stock_company       dict/stock_company.parquet          NONE        -           ts_code                               monthly  by_exchange    100
namechange          dict/namechange.parquet             NONE        -           ts_code                               monthly  by_date        100
new_share           dict/new_share.parquet              NONE        -           ts_code                               daily    by_date        100
dividend            events/dividend.parquet             NONE        ann_date    ts_code_id                            daily    by_date        100
disclosure_date     events/disclosure_date.parquet      NONE        ann_date    ts_code_id,ann_date_int               daily    by_period      30
suspend_d           events/suspend_d                    YEAR_MONTH  trade_date  year_month,ts_code_id,trade_date_int  daily    by_date        100
broker_recommend    research/broker_recommend.parquet   NONE        month       month,broker,ts_code_id               monthly  by_month       100
report_rc           research/report_rc                  YEAR_MONTH  ann_date    year_month,ts_code_id,ann_date_int    daily    by_date        100
stock_basic         dict/stock_basic_dict.parquet       NONE        -           ts_code                               weekly   by_exchange    100
trade_cal           dict/trade_calendar.parquet         NONE        -           cal_date                              weekly   by_date_range  100
"""


def _entries():
    for line in _TABLE.strip().splitlines():
        name, path, granularity, field, sort, frequency, strategy, size = line.split()
        yield DatasetSpec(
            name,
            path,
            granularity,
            None if field == "-" else field,
            tuple(sort.split(",")),
            frequency,
            strategy,
            int(size),
        )


CATALOG: dict[str, DatasetSpec] = {spec.name: spec for spec in _entries()}


def dataset(name: str) -> DatasetSpec:
    if name not in CATALOG:
        raise ValueError(f"unknown dataset {name}")
    return CATALOG[name]


def select_strategy(name: str, catalog: dict[str, DatasetSpec] = CATALOG, frequency: str | None = None) -> str:
    """Layout of a dataset: its own entry, else one suited to the frequency."""
    if name in catalog:
        return catalog[name].granularity
    return {"daily": YEAR, "weekly": YEAR, "monthly": MERGE}.get(frequency or "", NONE)


def due_datasets(day_of_week: int, day_of_month: int, catalog: dict[str, DatasetSpec] = CATALOG) -> list[str]:
    """Datasets to refresh: weekly ones on Monday (1), monthly ones on the 1st, daily always."""
    due = {"daily": True, "weekly": day_of_week == 1, "monthly": day_of_month == 1}
    return [s.name for s in catalog.values() if due.get(s.frequency, False)]
