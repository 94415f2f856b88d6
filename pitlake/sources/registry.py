"""The source registry as a small DataFrame.

Each registered source is a row: how often it publishes (``freq``), what one
fetch covers (``scope``), when a row becomes usable (``avail_rule``), which
request parameters it takes, and -- for the two bundled sources -- how raw
column names map to standard names.  ``freq`` decides the join path in the
panel: ``D`` / ``static`` join by equality, everything else as-of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: registered sources, must equal the reference registry ---
# (id, source_domain, freq, scope, avail_rule, params separated by ",")
SOURCES = [
    ("stock_zh_a_hist", "sina", "D", "single_stock_date_range", "T_day_1500", ""),
    ("tool_trade_date_hist_sina", "sina", "static", "market_wide", "T_day_1500", ""),
    ("stock_gpzy_pledge_ratio_em", "eastmoney.com", "D", "market_wide_single_day", "T_day_1500", "date"),
    ("stock_szse_summary", "szse.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_szse_sector_summary", "szse.cn", "M_Y", "market_wide_date_range", "T_plus_5", "symbol,date"),
    ("stock_sse_deal_daily", "sse.com.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_gsrl_gsdt_em", "eastmoney.com", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_tfp_em", "eastmoney.com", "D", "market_wide_single_day", "T_day_1500", "date"),
    ("news_trade_notify_suspend_baidu", "baidu.com", "D", "market_wide_single_day", "T_day_1500", "symbol"),
    ("stock_yjbb_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_yjkb_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_yjyg_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_yysj_em", "eastmoney.com", "event", "market_wide", "announcement_date", ""),
    ("stock_report_disclosure", "cninfo.com.cn", "event", "market_wide", "announcement_date", "market,date"),
    ("stock_industry_change_cninfo", "cninfo.com.cn", "event", "single_stock_history", "change_date", "symbol"),
    ("stock_share_change_cninfo", "cninfo.com.cn", "event", "single_stock_date_range", "change_date", "symbol,start_date,end_date"),
    ("stock_allotment_cninfo", "cninfo.com.cn", "event", "single_stock_history", "announcement_date", "symbol"),
    ("stock_zcfz_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_lrb_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_xjll_em", "eastmoney.com", "Q_A", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_fhps_em", "eastmoney.com", "A_H", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_zdhtmx_em", "eastmoney.com", "event", "market_wide_date_range", "announcement_date", "start_date,end_date"),
    ("stock_notice_report", "eastmoney.com", "D", "market_wide_single_day", "announcement_date", "date"),
    ("stock_gdfx_free_top_10_em", "eastmoney.com", "Q", "single_stock_by_report_date", "announcement_date", "symbol,date"),
    ("stock_gdfx_top_10_em", "eastmoney.com", "Q", "single_stock_by_report_date", "announcement_date", "symbol,date"),
    ("stock_gdfx_free_holding_change_em", "eastmoney.com", "Q", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_gdfx_holding_change_em", "eastmoney.com", "Q", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_gdfx_free_holding_detail_em", "eastmoney.com", "Q", "market_wide_by_report_date", "announcement_date", "date"),
    ("stock_info_a_code_name", "akshare", "static", "market_wide", "T_day_1500", ""),
    ("stock_info_sz_delist", "szse.cn", "event", "market_wide", "announcement_date", ""),
    ("stock_info_sh_delist", "sse.com.cn", "event", "market_wide", "announcement_date", ""),
    ("stock_hold_num_cninfo", "cninfo.com.cn", "Q", "single_stock_date_range", "announcement_date", "symbol,start_date,end_date"),
    ("stock_report_fund_hold", "eastmoney.com", "Q", "market_wide_by_report_date", "announcement_date", "symbol,date"),
    ("stock_lhb_detail_daily_sina", "sina.com.cn", "D", "market_wide_single_day", "T_plus_1", "trade_date,symbol"),
    ("stock_margin_ratio_pa", "pingan.com.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_margin_sse", "sse.com.cn", "D", "market_wide_single_day", "T_plus_1", "start_date,end_date"),
    ("stock_margin_detail_sse", "sse.com.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_margin_szse", "szse.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_margin_detail_szse", "szse.cn", "D", "market_wide_single_day", "T_plus_1", "date"),
    ("stock_margin_underlying_info_szse", "szse.cn", "event", "market_wide", "announcement_date", "date"),
    ("stock_board_industry_index_ths", "10jqka.com.cn", "D", "market_wide_single_day", "T_day_1500", "symbol"),
    ("stock_hot_search_baidu", "baidu.com", "D", "market_wide", "T_day_1500", ""),
    ("bond_cash_summary_sse", "sse.com.cn", "D", "market_wide_single_day", "T_day_1500", "symbol"),
    ("bond_deal_summary_sse", "sse.com.cn", "D", "market_wide_single_day", "T_day_1500", ""),
    ("bond_china_yield", "chinabond.com.cn", "D", "market_wide_single_day", "T_day_1500", "start_date,end_date"),
    ("fund_report_stock_cninfo", "cninfo.com.cn", "Q", "market_wide_by_report_date", "announcement_date", "symbol,date"),
    ("fund_report_industry_allocation_cninfo", "cninfo.com.cn", "Q", "market_wide_by_report_date", "announcement_date", "date"),
    ("macro_info_ws", "wsj.com", "event", "market_wide", "announcement_date", ""),
    ("stock_report_fund_hold_detail", "eastmoney.com", "Q", "market_wide_by_report_date", "announcement_date", "symbol,date"),
]

# --- fixed values: column maps of the two bundled sources ---
COLUMNS_MAP = {
    "stock_zh_a_hist": {
        "日期": "date", "开盘": "open", "收盘": "close", "最高": "high", "最低": "low",
        "成交量": "volume", "成交额": "amount", "换手率": "turnover", "后复权价": "adj_close_hfq",
    },
    "tool_trade_date_hist_sina": {"trade_date": "date"},
}

# --- fixed values: file name pattern of the two bundled sources ---
BOOTSTRAP_SOURCE = {
    "stock_zh_a_hist": "price_{ticker}.csv",
    "tool_trade_date_hist_sina": "trading_calendar.csv",
}

# --- fixed values: entity-code column and date column of each source's documented output ---
# (None: the source has no such column; its rows are market-wide, or dated by the fetch date)
KEY_COLUMNS = {
    "stock_zh_a_hist": (None, "date"),
    "tool_trade_date_hist_sina": (None, "date"),
    "stock_gpzy_pledge_ratio_em": ("股票代码", "交易日期"),
    "stock_szse_summary": (None, None),
    "stock_szse_sector_summary": (None, None),
    "stock_sse_deal_daily": (None, None),
    "stock_gsrl_gsdt_em": ("代码", "交易日"),
    "stock_tfp_em": ("代码", "停牌时间"),
    "news_trade_notify_suspend_baidu": ("股票代码", "停牌时间"),
    "stock_yjbb_em": ("股票代码", "最新公告日期"),
    "stock_yjkb_em": ("股票代码", "公告日期"),
    "stock_yjyg_em": ("股票代码", "公告日期"),
    "stock_yysj_em": ("股票代码", "首次预约时间"),
    "stock_report_disclosure": ("股票代码", None),
    "stock_industry_change_cninfo": ("证券代码", "变更日期"),
    "stock_share_change_cninfo": ("证券代码", "公告日期"),
    "stock_allotment_cninfo": ("证券代码", "上市公告日期"),
    "stock_zcfz_em": ("股票代码", "公告日期"),
    "stock_lrb_em": ("股票代码", "公告日期"),
    "stock_xjll_em": ("股票代码", "公告日期"),
    "stock_fhps_em": ("代码", "最新公告日期"),
    "stock_zdhtmx_em": ("股票代码", "公告日期"),
    "stock_notice_report": ("代码", "公告日期"),
    "stock_gdfx_free_top_10_em": (None, None),
    "stock_gdfx_top_10_em": (None, None),
    "stock_gdfx_free_holding_change_em": (None, None),
    "stock_gdfx_holding_change_em": (None, None),
    "stock_gdfx_free_holding_detail_em": ("股票代码", "公告日"),
    "stock_info_a_code_name": ("code", None),
    "stock_info_sz_delist": ("证券代码", "终止上市日期"),
    "stock_info_sh_delist": ("公司代码", "暂停上市日期"),
    "stock_hold_num_cninfo": ("证劵代码", "变动日期"),
    "stock_report_fund_hold": ("股票代码", None),
    "stock_lhb_detail_daily_sina": ("股票代码", None),
    "stock_margin_ratio_pa": ("证券代码", None),
    "stock_margin_sse": (None, "信用交易日期"),
    "stock_margin_detail_sse": ("标的证券代码", "信用交易日期"),
    "stock_margin_szse": (None, None),
    "stock_margin_detail_szse": ("证券代码", None),
    "stock_margin_underlying_info_szse": ("证券代码", None),
    "stock_board_industry_index_ths": (None, "日期"),
    "stock_hot_search_baidu": ("名称/代码", None),
    "bond_cash_summary_sse": (None, "数据日期"),
    "bond_deal_summary_sse": (None, "数据日期"),
    "bond_china_yield": (None, "日期"),
    "fund_report_stock_cninfo": ("股票代码", None),
    "fund_report_industry_allocation_cninfo": (None, None),
    "macro_info_ws": (None, "时间"),
    "stock_report_fund_hold_detail": ("股票代码", None),
}

# freq values joined by equality; all others are joined as-of
EQUI_FREQS = ("D", "static")

REGISTRY_SCHEMA = T.StructType([
    T.StructField("interface_id", T.StringType(), False),
    T.StructField("source_domain", T.StringType(), False),
    T.StructField("freq", T.StringType(), False),
    T.StructField("scope", T.StringType(), False),
    T.StructField("avail_rule", T.StringType(), False),
    T.StructField("params", T.ArrayType(T.StringType(), False), False),
])


def registry(spark: SparkSession) -> DataFrame:
    """All registered sources as a DataFrame (49 rows)."""
    rows = [(i, d, f, s, a, [p for p in ps.split(",") if p]) for i, d, f, s, a, ps in SOURCES]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def avail_rule_of(interface_id: str) -> str | None:
    for i, _, _, _, a, _ in SOURCES:
        if i == interface_id:
            return a
    return None


def freq_of(interface_id: str) -> str | None:
    for i, _, f, *_ in SOURCES:
        if i == interface_id:
            return f
    return None


def scope_of(interface_id: str) -> str | None:
    for i, _, _, s, *_ in SOURCES:
        if i == interface_id:
            return s
    return None
