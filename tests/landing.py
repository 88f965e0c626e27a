"""Fixture files as the sources land them, and short forms of expected rows."""

import json
from datetime import date
from decimal import Decimal
from pathlib import Path


def day(text):
    return date.fromisoformat(text)


def put_json(folder, name, content):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(json.dumps(content, indent=1), encoding="utf-8")
    return str(folder)


def put_text(folder, name, *lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def rates_a(code, **by_day):
    entries = [{"no": "1/A", "effectiveDate": d, "mid": m} for d, m in by_day.items()]
    return {"table": "A", "currency": "x", "code": code, "rates": entries}


def rates_c(code, **by_day):
    entries = [{"effectiveDate": d, "bid": b, "ask": a} for d, (b, a) in by_day.items()]
    return {"table": "C", "code": code, "rates": entries}


def gold(**by_day):
    return [{"data": d, "cena": p} for d, p in by_day.items()]


def rate(code, text, value):
    return (code, day(text), Decimal(value))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


HISTORY_HEADER = "Price,Close,High,Low,Open,Volume,Ticker"
INCREMENT_HEADER = "Date,Open,High,Low,Close,Volume,ticker,group_name"
