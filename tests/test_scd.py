"""Type 1 and type 2 merges on a master of 12 rows and a batch of 6."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tradewind import schemas
from tradewind.operators import scd

TRACKED = ("name", "email", "city", "status")
OLD, NEW = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def person(key, city="Oslo", status="active", email=True, at=OLD, name=None):
    return (key, name or f"Person {key}", f"p{key}@example.com" if email else None, city, status, at)


@pytest.fixture
def master(spark):
    people = [person(k) for k in range(1, 9)]
    # 9 and 10 differ in nothing but the key; 2 is there twice; 11 has no email
    people += [person(9, name="Twin"), person(10, name="Twin"), person(2), person(11, email=False)]
    return spark.createDataFrame(people, schemas.CUSTOMER_BATCH)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([
        person(1, city="Rome", at=NEW), person(3, status="inactive", at=NEW),
        person(6, name="Renamed", at=NEW), person(11, at=NEW), person(12, at=NEW),
        person(8, at=NEW)], schemas.CUSTOMER_BATCH)


def test_cleaning_keeps_ten(master):
    assert master.count() == 12
    assert master.na.drop().count() == 11
    assert scd.dim_clean(master).count() == 10


def test_scd1(master, batch):
    got = scd.scd1_merge(scd.dim_clean(master), batch, "customer_id")
    assert rows(scd.scd_validate(got, "customer_id")) == [(12, 12, 0)]
    by_key = {r.customer_id: r for r in got.collect()}
    assert by_key[1].city == "Rome" and by_key[8].updated_at == NEW and by_key[2].updated_at == OLD
    assert rows(scd.scd1_merge(got, batch, "customer_id")) == rows(got)


def test_scd2(master, batch):
    target = scd.scd2_open(scd.dim_clean(master), "updated_at")
    got = scd.scd2_merge(target, batch, "customer_id", TRACKED, "updated_at")
    assert rows(scd.scd_validate(got, "customer_id", current_only=True)) == [(15, 12, 0)]
    expired = got.filter(~F.col("is_current")).orderBy("customer_id").collect()
    assert [r.customer_id for r in expired] == [1, 3, 6]
    assert all(r.valid_from == OLD and r.valid_to == NEW for r in expired)
    fresh = got.filter("is_current AND customer_id IN (1, 3, 6, 11, 12)").collect()
    assert all(r.valid_from == NEW and r.valid_to is None for r in fresh)
    # 8 changed only its date, which is not tracked
    assert got.filter("customer_id = 8").first().updated_at == OLD
    assert rows(scd.scd2_merge(got, batch, "customer_id", TRACKED, "updated_at")) == rows(got)


def test_scd2_tracking_the_date_expires_one_more(master, batch):
    target = scd.scd2_open(scd.dim_clean(master), "updated_at")
    got = scd.scd2_merge(target, batch, "customer_id", (*TRACKED, "updated_at"), "updated_at")
    assert rows(scd.scd_validate(got, "customer_id", current_only=True)) == [(16, 12, 0)]


def test_scd2_null_becomes_value(spark, batch):
    target = scd.scd2_open(
        spark.createDataFrame([person(11, email=False)], schemas.CUSTOMER_BATCH), "updated_at")
    got = scd.scd2_merge(target, batch.filter("customer_id = 11"), "customer_id", TRACKED,
                         "updated_at")
    assert sorted((r.is_current, r.email) for r in got.collect()) \
        == [(False, None), (True, "p11@example.com")]


@pytest.mark.parametrize("merge", [
    lambda t, s: scd.scd1_merge(t, s, "customer_id"),
    lambda t, s: scd.scd2_merge(
        scd.scd2_open(t, "updated_at"), s, "customer_id", TRACKED, "updated_at")])
def test_repeated_source_keys_are_rejected(master, batch, merge):
    with pytest.raises(Exception, match="several source rows for key 1"):
        merge(scd.dim_clean(master), batch.unionByName(batch.filter("customer_id = 1"))).collect()


def test_null_keys_match_nothing(spark):
    a = spark.createDataFrame([person(None, city="A"), person(1)], schemas.CUSTOMER_BATCH)
    b = spark.createDataFrame(
        [person(None, city="B"), person(None, city="C")], schemas.CUSTOMER_BATCH)
    got = scd.scd1_merge(a, b, "customer_id")
    assert sorted(r.city for r in got.collect()) == ["A", "B", "C", "Oslo"]
    two = scd.scd2_merge(scd.scd2_open(a, "updated_at"), b, "customer_id", TRACKED, "updated_at")
    assert sorted(r.city for r in two.collect()) == ["A", "B", "C", "Oslo"]
