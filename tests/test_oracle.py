"""Every registered query against its DuckDB oracle on the sf0.001 tables.

The model (D) and catalog queries are evaluated on one shared warehouse so
intermediates are built once; the registry wiring itself is exercised by
test_entry.py.
"""
from decimal import Decimal

import pytest

from conewise import catalog, registry


def _norm(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    return v


def _rows(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


def _check(sdf, sql, duck):
    scols = sdf.columns
    srows = sdf.collect()
    duck.execute(f"create or replace temp view expected as {sql}")  # a query that cannot stand in a view is no oracle
    rel = duck.execute("select * from expected")
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(srows, scols, scols) == _rows(drows, dcols, scols)


ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("qid", list(registry.MODELS))
def test_model_matches_oracle(qid, shop, duck):
    attr, _ = registry.MODELS[qid]
    _check(registry.normalize(shop.model(attr)), ORACLE[qid], duck)


@pytest.mark.parametrize("qid", [k for k in catalog.ON_SHOP if k in ORACLE])
def test_catalog_matches_oracle(qid, shop, duck):
    _check(registry.normalize(catalog.ON_SHOP[qid](shop)), ORACLE[qid], duck)
