"""Order files, products and expected Gold rows of the two worked cases (FIXTURES.md)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path

# Fixed values from here to the products: worked files and the Gold rows they must give.
HEADER = "order_id,order_date,customer_id,product_id,quantity,unit_price,region"

DAY1 = """O1001,2024-01-01,C001,P001,1,24.99,East
O1002,2024-01-01,C002,P002,2,"$1,099.00",West
O1003,2024-01-01,C003,P004,5,8.99,west
O1004,2024-01-01,,P003,6,3.50,North
O1005,2024-01-01,C005,P005,3,12.00,East
O1006,2024-01-01,C006,P006,4,7.50,South
O1007,2024-01-01,C007,P007,1,$49.95,South
O1008,2024-01-01,C008,P003,0,3.50,North
O1009,2024-01-01,C009,P099,2,15.00,East
O1010,2024-01-01,C010,P010,1,29.99,West
O1011,2024-01-01,C011,P001,2,24.99,East,EXTRA_FLAG
O1012,2024-01-01,C012,P004,4,8.99,West"""

DAY2 = """O1002,2024-01-01,C002,P002,2,"$1,099.00",West
O1003,2024-01-01,C003,P004,6,8.99,west
O2001,01/02/2024,C013,P007,1,49.95,West
O2002,1704153600,C014,P001,3,24.99,East
O2003,2024-01-02,C015,P004,5,8.99,north
O2004,2024-01-02,C002,P002,-1,"$1,099.00",West
O2005,2024-01-02,,P005,2,12.00,South
O2006,2024-01-02,C016,P006,3,7.50,West
O2007,2024-01-02,C017,P011,1,19.99,South
O2008,2024-01-02,C018,P008,4,9.99,East
O2009,2024-01-02,C019,P010,1,,West
O2010,2024-01-02,C020,P003,2,3.50,East"""

DAY3 = """O3001,2024-01-03,C021,P001,2,$24.99,North
O3002,2024-01-03,C022,P009,1,39.00,West
O2008,2024-01-02,C018,P008,6,9.99,East
O3003,1704240000,C023,P007,1,"$1,049.95",south
O3004,2024-01-03,C024,P012,1,15.00,East
O3005,2024-01-03,C025,P003,-2,3.50,North"""

DAYS = {"2024-01-01": DAY1, "2024-01-02": DAY2, "2024-01-03": DAY3}

PRODUCTS = """ Product_ID ,PRODUCT_NAME,Category,list_price
P001,Wireless Mouse,Electronics,24.99
P002,Laptop,electronics,1099.00
P003,Notebook,Stationery,3.50
P004,USB Cable,Electronics,8.99
P005,Mug,kitchen,12.00
P006,Spatula,Kitchen,7.50
P007,Backpack,Accessories,49.95
P008,Pen Set,Stationery,9.99
P009,Desk Lamp,Home & Office,39.00
P010,Desk Organizer,Home & Office,29.99"""

# case | date | category | region | revenue | orders | units | average; C marks both cases.
GOLD = """C | 2024-01-01 | Accessories | South | 49.95 | 1 | 1 | 49.95
C | 2024-01-01 | Electronics | East | 74.97 | 2 | 3 | 37.49
C | 2024-01-01 | Electronics | West | 2287.90 | 3 | 12 | 762.63
C | 2024-01-01 | Home & Office | West | 29.99 | 1 | 1 | 29.99
C | 2024-01-01 | Kitchen | East | 36.00 | 1 | 3 | 36.00
C | 2024-01-01 | Kitchen | South | 30.00 | 1 | 4 | 30.00
C | 2024-01-01 | Stationery | North | 21.00 | 2 | 6 | 10.50
C | 2024-01-01 | Unknown | East | 30.00 | 1 | 2 | 30.00
C | 2024-01-02 | Accessories | West | 49.95 | 1 | 1 | 49.95
C | 2024-01-02 | Electronics | East | 74.97 | 1 | 3 | 74.97
C | 2024-01-02 | Electronics | North | 44.95 | 1 | 5 | 44.95
C | 2024-01-02 | Electronics | West | -1099.00 | 1 | -1 | -1099.00
C | 2024-01-02 | Kitchen | South | 24.00 | 1 | 2 | 24.00
C | 2024-01-02 | Kitchen | West | 22.50 | 1 | 3 | 22.50
A | 2024-01-02 | Stationery | East | 46.96 | 2 | 6 | 23.48
B | 2024-01-02 | Stationery | East | 66.94 | 2 | 8 | 33.47
C | 2024-01-02 | Unknown | South | 19.99 | 1 | 1 | 19.99
B | 2024-01-03 | Accessories | South | 1049.95 | 1 | 1 | 1049.95
B | 2024-01-03 | Electronics | North | 49.98 | 1 | 2 | 49.98
B | 2024-01-03 | Home & Office | West | 39.00 | 1 | 1 | 39.00
B | 2024-01-03 | Stationery | North | -7.00 | 1 | -2 | -7.00
B | 2024-01-03 | Unknown | East | 15.00 | 1 | 1 | 15.00"""


def expected_gold(case: str) -> list[tuple]:
    rows = [[cell.strip() for cell in line.split("|")] for line in GOLD.splitlines()]
    return sorted(
        (date.fromisoformat(day), category, region, Decimal(revenue), int(orders), int(units), Decimal(aov))
        for mark, day, category, region, revenue, orders, units, aov in rows
        if mark in ("C", case)
    )


def drop_file(inbox: Path, day: str, lines: str | None = None, suffix: str = "") -> None:
    inbox.mkdir(parents=True, exist_ok=True)
    (inbox / f"orders_{day}{suffix}.csv").write_text(f"{HEADER}\n{DAYS[day] if lines is None else lines}\n")


def product_file(folder: Path, text: str = PRODUCTS) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "products.csv").write_text(text + "\n")
    return str(folder / "products.csv")
