"""Hand-written rows (FIXTURES.md part C) with the cases the driver tables lack."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

T = dt.datetime

ORDERS_SCHEMA = "order_id bigint, customer_id bigint, status string, ordered_at timestamp_ntz"
ORDERS = [
    (1, 10, "F", T(2020, 1, 5, 9)),      # two orders of one customer on one day (tie)
    (2, 10, "F", T(2020, 1, 5, 18)),
    (3, 99, "O", T(2020, 1, 20)),        # customer missing from the dimension
    (4, None, "O", T(2020, 1, 21)),      # null customer
    (5, 11, " p ", T(2020, 3, 2)),       # month without orders (February) before it
    (6, 10, "F", T(2020, 12, 31, 23)),   # last day of a year
    (7, 12, "F", T(2020, 3, 15)),        # order without lines
]

LINES_SCHEMA = ("order_id bigint, line_no int, product_id bigint, seller_id bigint, price decimal(18,2), "
                "discount decimal(4,2), qty int")
LINES = [
    (1, 1, 100, 1000, D("100.00"), D("0.00"), 1),   # discount 0
    (1, 2, 101, 1000, D("50.00"), D("1.00"), 2),    # discount 1
    (2, 1, 100, 1001, D("10.05"), D("0.10"), 3),
    (3, 1, 101, 1001, D("20.00"), D("0.05"), 1),
    (5, 1, 100, 1000, D("30.00"), D("0.00"), 1),
    (6, 1, 100, 1000, D("40.00"), D("0.00"), 1),
    (6, 1, 100, 1000, D("40.00"), D("0.00"), 1),    # exact repeated row
    (8, 1, 100, 1000, D("5.00"), D("0.00"), 1),     # line whose order is missing
]

PAYMENTS_SCHEMA = ("order_id bigint, customer_id bigint, seq int, type string, amount decimal(18,2), "
                   "paid_at timestamp_ntz")
PAYMENTS = [
    (1, 10, 1, "credit_card", D("60.00"), T(2020, 1, 5, 10)),   # two payments for an order with two lines
    (1, 10, 2, "voucher", D("40.00"), T(2020, 1, 5, 10)),
    (2, 10, 1, None, D("9.05"), T(2020, 1, 5, 19)),             # type null
    (3, 99, 1, "  ", D("19.00"), T(2020, 1, 20)),               # blank
    (5, 11, 1, "Credit_Card", D("0.00"), T(2020, 3, 2)),        # mixed case, amount 0
    (6, 10, 1, "boleto", D("40.00"), T(2020, 12, 31)),          # type not in the pivot list
]

RATINGS_SCHEMA = "rating_id bigint, order_id bigint, score int, comment string, rated_at timestamp_ntz"
RATINGS = [
    (1, 1, 1, "bad", T(2020, 1, 10)),
    (2, 2, 2, None, T(2020, 1, 10)),             # null comment
    (3, 3, 3, "", T(2020, 1, 11)),               # empty comment
    (4, 5, 4, "good", T(2020, 3, 5)),
    (5, 6, 5, "great stuff", T(2021, 1, 2)),
    (6, 6, 5, "great stuff", T(2021, 1, 3)),     # two ratings of one order, equal comments
    (7, 7, 1, "great stuff", T(2020, 3, 20)),    # equal comment, different score
    (8, 1, 0, "zero", T(2020, 1, 10)),           # score 0 (reject)
    (9, 2, 6, "six", T(2020, 1, 10)),            # score 6 (reject)
]

CUSTOMERS_SCHEMA = "customer_id bigint, city string, state string, loaded_at timestamp_ntz"
CUSTOMERS = [
    (10, "sao paulo", "SP", T(2020, 1, 1)),
    (10, " Sao Paulo ", "sp", T(2020, 6, 1)),   # same customer, later date: latest wins
    (11, "rio", "RJ", T(2020, 1, 1)),
    (11, "Niteroi", "RJ", T(2020, 1, 1)),       # equal dates: tie broken by the other columns
    (12, "Curitiba", "PR", T(2020, 1, 1)),      # customer without orders... has order 7 (no lines)
    (13, "Recife", "PE", T(2020, 1, 1)),        # customer without orders
]
