"""The brokerage sample: fixed values that the golden numbers in the tests belong to."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

AS_OF = dt.date(2026, 3, 11)

# Customer, name, risk class, contract date, representative.
CUSTOMERS = """
C001,山田太郎,バランス,2023-04-15,田中一郎
C002,佐藤花子,保守的,2022-11-20,鈴木次郎
C003,鈴木一郎,積極的,2024-01-10,田中一郎
C004,田中美咲,バランス,2023-08-05,佐藤三郎
C005,伊藤健太,積極的,2024-02-20,田中一郎
C006,渡辺由美,保守的,2022-06-30,鈴木次郎
C007,中村大輔,バランス,2023-12-01,佐藤三郎
C008,小林恵子,保守的,2023-05-18,鈴木次郎
C009,加藤翔太,積極的,2024-03-10,田中一郎
C010,吉田陽子,バランス,2023-09-25,佐藤三郎
"""

# Customer, stock, quantity, purchase price, purchase date; the last row is spoiled.
HOLDINGS = """
C001,7203,100,1850.00,2023-05-20
C001,9984,50,3200.00,2023-06-15
C001,6758,200,1450.00,2023-07-10
C002,8306,30,5500.00,2023-01-25
C002,8316,40,2800.00,2023-03-10
C002,9434,100,1950.00,2023-04-20
C003,6502,150,4200.00,2024-02-01
C003,7974,80,12500.00,2024-02-15
C003,4063,200,8300.00,2024-03-05
C004,2914,100,3800.00,2023-09-10
C004,8001,50,6200.00,2023-10-15
C004,9501,80,2100.00,2023-11-20
C005,4568,120,5800.00,2024-03-01
C005,4755,200,3100.00,2024-03-15
C005,6861,300,1850.00,2024-04-10
C006,2802,150,2400.00,2022-08-15
C006,8058,100,3200.00,2022-09-20
C006,9432,80,2650.00,2022-10-25
C007,7201,60,3950.00,2024-01-10
C007,7267,90,4100.00,2024-01-25
C007,5401,120,2850.00,2024-02-15
C008,9101,50,4200.00,2023-07-01
C008,9104,70,2850.00,2023-08-10
C008,9107,100,1950.00,2023-09-15
C009,3382,250,2300.00,2024-04-05
C009,4324,180,5200.00,2024-04-20
C009,4689,300,1650.00,2024-05-01
C010,8035,90,8500.00,2023-11-01
C010,8053,120,2950.00,2023-11-20
C010,7732,150,3400.00,2023-12-10
C999,XXXX,NOT_A_NUMBER,abc,2024-13-99
"""

# Stock, sector, closing price.
PRICES = """
7203,自動車,1920
9984,通信,3420
6758,電機,1520
8306,銀行,5680
8316,銀行,2890
9434,通信,2080
6502,電機,4580
7974,その他製品,13100
4063,化学,8450
2914,食品,4020
8001,卸売,6350
9501,電力,2240
4568,医薬品,6180
4755,情報通信,3250
6861,電機,1970
2802,食品,2510
8058,卸売,3280
9432,通信,2720
7201,自動車,4120
7267,自動車,4180
5401,鉄鋼,2920
9101,海運,4320
9104,海運,2950
9107,海運,2080
3382,小売,2430
4324,サービス,5380
4689,情報通信,1720
8035,卸売,8750
8053,卸売,3050
7732,精密機器,3520
"""

# Risk class, sector, target percentage.
TARGETS = """
保守的,銀行,20
保守的,食品,15
保守的,通信,15
保守的,電力,10
保守的,医薬品,10
保守的,卸売,10
保守的,その他,20
バランス,自動車,15
バランス,電機,15
バランス,銀行,10
バランス,通信,10
バランス,化学,10
バランス,医薬品,10
バランス,その他,30
積極的,情報通信,20
積極的,電機,15
積極的,その他製品,10
積極的,化学,10
積極的,医薬品,10
積極的,海運,10
積極的,その他,25
"""

HOLDING_HEADER = "customer_id,stock_code,quantity,avg_purchase_price,purchase_date"
PRICE_HEADER = "stock_code,stock_name,sector,price_date,closing_price,volume,week52_high,week52_low"


def lines(block: str) -> list[str]:
    return block.strip().splitlines()


def rows(block: str) -> list[list[str]]:
    return [line.split(",") for line in lines(block)]


def holdings(spark):
    data = [(c, s, Decimal(q), Decimal(p), dt.date.fromisoformat(d)) for c, s, q, p, d in rows(HOLDINGS)[:30]]
    return spark.createDataFrame(
        data, "customer_id string, stock_code string, quantity decimal(10,0), avg_purchase_price decimal(12,2), purchase_date date")


def prices(spark):
    data = [(s, f"stock {s}", sector, AS_OF, Decimal(p)) for s, sector, p in rows(PRICES)]
    return spark.createDataFrame(data, "stock_code string, stock_name string, sector string, price_date date, closing_price decimal(12,2)")


def customers(spark):
    data = [(c, n, r, dt.date.fromisoformat(d), rep) for c, n, r, d, rep in rows(CUSTOMERS)]
    return spark.createDataFrame(data, "customer_id string, customer_name string, risk_tolerance string, contract_date date, sales_rep string")


def targets(spark):
    data = [(r, s, Decimal(t)) for r, s, t in rows(TARGETS)]
    return spark.createDataFrame(data, "risk_tolerance string, sector string, target_ratio decimal(5,2)")


def price_file_lines() -> list[str]:
    return [PRICE_HEADER] + [f"{s},stock {s},{sector},{AS_OF},{p},1000,{p},{p}" for s, sector, p in rows(PRICES)]


def holding_file_lines() -> list[str]:
    return [HOLDING_HEADER] + lines(HOLDINGS)


def write(path, file_lines: list[str], newline: str = "\r\n", final_newline: bool = False) -> str:
    text = newline.join(file_lines) + (newline if final_newline else "")
    path.write_bytes(text.encode("utf-8"))
    return str(path)
