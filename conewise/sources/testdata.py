"""Bindings from the driver's test tables to the shop's raw tables.

The driver ships TPC-H-like tables (``orders``, ``lineitem``, ``customer`` ...).
The shop models need orders, order lines, line flavours, customers, addresses,
zones, products, flavours, categories, deliveries and seven CSV seeds.  Each
raw table below is a deterministic SELECT over the test tables, written once
and rendered for two engines: Spark (``spark.sql`` with DataFrame arguments,
no global views) and DuckDB (the oracle, where the test tables are views).
Every binding reads whole tables and every key grows with them: identities are
small groups of customers that share an e-mail or a phone, plus one catch-all
e-mail (a fiftieth of the customers), the hot key of the identity models.

Some bindings leave rows out on purpose, as gaps are features of the models:
``dolar_blue`` has no weekends (the rate is filled forward), ``costos_sabores``
lacks flavours and months (the month's mean steps in),
``registro_diario_ventas`` lacks days (sales without a register row),
``points_clientes`` lacks a tenth of the users (movements without a customer),
``delivery`` holds delivered orders only, and a tenth of the customers has one
address.

The arithmetic on keys exists to hit every branch the models have: shared, catch-all and
blank e-mails, trimmed phones, catch-all customers 0 and 1, order phones with
ties, missing addresses, products for each weight rule, flavours without a
cost or without a month, weekend gaps in the rate, days with sales but no
register row and the reverse, expired and live loyalty points.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from conewise.operators.dealing import deal
from conewise.sources.sinks import input_root, materialise_once

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Product names chosen so that each rule of the weight ladder is
# hit once, in ladder order, plus one lower-case "1 kg" that the exact rule
# must not match.  Indexed by p_size % 16.
PRODUCT_LABELS = [
    "Pack 5 Cucuruchos", "Pack 4 cucuruchos", "Promo 4 de 1/2", "Promo 3 de 1/4",
    "Promo 1kg + 1/2", "Promo 2 x 1/4", "Pote 1/2 kg", "Pote 1/4kg",
    "Pote 3/4 KG", "1 KG", "1kg clasico", "Capelina",
    "Vasito", "Cucurucho", "Agua", "1 kg",
]

# Expense categories as typed by hand (odd case, stray spaces, unknowns, null),
# indexed by l_partkey % 16.
EXPENSE_CATEGORIES = [
    " Insumos", "ALIMENTOS", "logistica ", "Inversion", "Marketing", "MOD",
    "mod jorge", "Servicios", "Alquiler", "Potes", "impuestos", "electricidad",
    "Comisiones", "cosa rara", None, "Inscripción",
]

# Expense means of payment as typed by hand, indexed by l_suppkey % 6.
EXPENSE_MEANS = ["efectivo", " TC", "tc visa", "MP", "transferencia", None]


class _Dialect:
    name = ""

    def t(self, name: str) -> str:  # table reference
        raise NotImplementedError

    def date(self, x: str) -> str:
        raise NotImplementedError

    def days(self, x: str) -> str:  # days since 1970-01-01
        raise NotImplementedError

    def weekday(self, x: str) -> str:  # 0 = Monday
        raise NotImplementedError

    def dayname(self, x: str) -> str:
        raise NotImplementedError

    def ym(self, x: str) -> str:  # 'YYYY-MM'
        raise NotImplementedError

    def add_days(self, d: str, n: str) -> str:
        raise NotImplementedError

    def s(self, x: str) -> str:  # to text
        raise NotImplementedError

    def pick(self, values: list, idx0: str) -> str:  # values[idx0], 0-based, one evaluation of idx0
        raise NotImplementedError


class _Spark(_Dialect):
    name = "spark"

    def t(self, name):
        return "{" + name + "}"

    def date(self, x):
        return f"to_date({x})"

    def days(self, x):
        return f"datediff(to_date({x}), date'1970-01-01')"

    def weekday(self, x):
        return f"weekday({x})"

    def dayname(self, x):
        return f"date_format({x}, 'EEEE')"

    def ym(self, x):
        return f"date_format({x}, 'yyyy-MM')"

    def add_days(self, d, n):
        return f"date_add({d}, cast({n} as int))"

    def s(self, x):
        return f"cast({x} as string)"

    def pick(self, values, idx0):
        return f"element_at(array({_lits(values)}), cast({idx0} as int) + 1)"


class _Duck(_Dialect):
    name = "duckdb"

    def t(self, name):
        return name

    def date(self, x):
        return f"cast({x} as date)"

    def days(self, x):
        return f"date_diff('day', date '1970-01-01', cast({x} as date))"

    def weekday(self, x):
        return f"(isodow({x}) - 1)"

    def dayname(self, x):
        return f"dayname({x})"

    def ym(self, x):
        return f"strftime({x}, '%Y-%m')"

    def add_days(self, d, n):
        return f"({d} + cast({n} as integer))"

    def s(self, x):
        return f"cast({x} as varchar)"

    def pick(self, values, idx0):
        return f"([{_lits(values)}])[cast({idx0} as integer) + 1]"


SPARK = _Spark()
DUCK = _Duck()


def _lits(values: list) -> str:
    return ", ".join("cast(null as string)" if v is None else "'" + v.replace("'", "''") + "'" for v in values)


def _raw_sql(d: _Dialect) -> dict[str, str]:
    """Raw shop tables as SELECTs over the test tables (one dialect)."""
    o, li, c = d.t("orders"), d.t("lineitem"), d.t("customer")
    retiro = (
        "case when o_orderkey % 101 = 0 then null when o_orderkey % 3 = 0 then 'delivery' "
        "when o_orderkey % 3 = 1 then 'local' else 'mostrador' end"
    )
    pago = (
        "case o_orderpriority when '1-URGENT' then 'cash' when '2-HIGH' then 'mp' "
        "when '3-MEDIUM' then 'transfer' when '4-NOT SPECIFIED' then 'cash' else 'qr' end"
    )
    epoch_1995 = 788918400  # 1995-01-01 00:00:00 UTC in Unix seconds
    q = {}
    q["pedidos"] = f"""
select codigo, cliente, direccion, tipo_retiro, tipo_pago,
  case when tipo_pago = 'mp' then concat('MP', {d.s('codigo')}) end as mp_ID,
  case when tipo_pago = 'mp' then 'approved' end as mp_Status,
  case when tipo_pago = 'mp' then total end as mp_TransactionAmount,
  case when tipo_pago = 'mp' then total end as mp_totalPaidAmount,
  case when tipo_pago = 'mp' then total - round(total * 0.05, 2) end as mp_netReceivedAmount,
  case when tipo_pago = 'mp' then round(total * 0.05, 2) end as mp_Fee,
  case when tipo_pago = 'mp' then 'credit_card' end as mp_PaymentType,
  telefono, cast(null as {'string' if d.name == 'spark' else 'varchar'}) as comentario,
  total + descuento - envio as subtotal, cast(0 as decimal(12,2)) as redondeo, total, envio,
  descuento, cast(0 as decimal(12,2)) as descuento_ajuste, cast(0 as decimal(12,2)) as descuento_alianza,
  cast(null as decimal(12,2)) as abona_con, estado,
  case when estado = 3 then 1 else 0 end as pagado,
  case when tipo_retiro = 'delivery' then 20 + cast(codigo % 40 as int) end as demora,
  case when tipo_retiro = 'delivery' then cast(codigo % 70 as double) / 10 end as distancia,
  case when tipo_retiro = 'delivery' then concat('rep', {d.s('codigo % 5')}) end as repartidor,
  case when estado = 4 then 'sin stock' end as motivo,
  case when codigo % 40 = 0 then 0 else 1 end as activo,
  fecha_sys, fecha_sys + 600 as last_fecha_update, 1 as admin_insert,
  cast(null as int) as last_admin_update
from (
  select o_orderkey as codigo, o_custkey as cliente,
    case when o_orderkey % 20 <> 7 then o_custkey * 2 + o_orderkey % 2 end as direccion,
    {retiro} as tipo_retiro, {pago} as tipo_pago,
    case when o_custkey % 14 = 0
         then concat(case when o_orderkey % 4 = 1 then ' ' else '' end, '77',
                     {d.s('o_custkey - o_custkey % 28 + o_orderkey % 2')})
         when o_orderkey % 5 = 0 then '' end as telefono,
    cast(o_totalprice as decimal(12,2)) as total,
    case when o_orderkey % 3 = 0 and o_orderkey % 101 != 0
         then cast(o_orderkey % 5 * 100 as decimal(12,2)) else cast(0 as decimal(12,2)) end as envio,
    cast(o_orderkey % 4 * 10 as decimal(12,2)) as descuento,
    case when o_orderstatus = 'F' then 3
         when o_orderstatus = 'O' and o_orderkey % 10 = 0 then 1
         when o_orderstatus = 'O' then 2
         when o_orderstatus = 'P' then 4 end as estado,
    {d.days('o_orderdate')} * 86400 + ((o_orderkey * 7) % 24) * 3600 + (o_orderkey % 60) * 60 as fecha_sys
  from {o}
) x"""
    q["pedidos_productos"] = f"""
select l_orderkey * 8 + l_linenumber as codigo, l_orderkey as id_pedido,
  min(l_partkey) as id_producto, cast(null as {'string' if d.name == 'spark' else 'varchar'}) as extras,
  1 as activo, min({d.days('l_shipdate')}) * 86400 as fecha_sys,
  min({d.days('l_shipdate')}) * 86400 as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {li}
group by l_orderkey, l_linenumber"""
    q["pedidos_productos_sabores"] = f"""
select concat({d.s('l_orderkey')}, '-', {d.s('l_linenumber')}, '-', {d.s('l_suppkey')}) as codigo,
  l_orderkey * 8 + l_linenumber as id_pedido_producto, l_suppkey as sabor,
  1 as activo, {d.days('l_shipdate')} * 86400 as fecha_sys,
  {d.days('l_shipdate')} * 86400 as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {li}"""
    q["clientes"] = f"""
select c_custkey as codigo, c_name as nombre,
  case when c_custkey % 3 = 0 then null when c_custkey % 29 = 1 then ''
       when c_custkey % 31 = 2 then ' '
       when c_custkey % 50 = 7 then 'sin-mail@mail.com'
       else concat('m', {d.s('c_custkey - c_custkey % 5')}, '@mail.com') end as email,
  case when c_custkey % 7 = 0 then '' when c_custkey % 11 = 0 then null
       when c_custkey % 15 = 0 then concat('99', {d.s('c_custkey - c_custkey % 30')})
       else concat(' 55', {d.s('c_custkey - c_custkey % 4')}) end as telefono,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as google_id,
  c_mktsegment as tipo,
  case when c_custkey % 17 = 0 then 0 else 1 end as activo,
  {epoch_1995} + (c_custkey % 700) * 86400 as fecha_sys,
  {epoch_1995} + (c_custkey % 700) * 86400 as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {c}"""
    q["clientes_direcciones"] = f"""
select c_custkey * 2 + k as codigo, c_custkey as cliente,
  concat('Calle ', {d.s('c_custkey')}, ' ', {d.s('100 + k')}) as direccion,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as piso,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as depto,
  case when (c_custkey + k) % 9 = 0 then null else concat('Barrio ', {d.s('(c_custkey + k) % 13')}) end as barrio,
  cast(null as double) as map_lat, cast(null as double) as map_lng,
  cast((c_custkey + k) % 50 as double) / 10 as distancia,
  case when (c_custkey + k) % 23 = 0 then null when k = 0 then c_nationkey else (c_nationkey + 1) % 25 end as zona,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as observaciones,
  case when k = 1 and c_custkey % 4 = 0 then 0 else 1 end as activo,
  {epoch_1995} + (c_custkey % 700) * 86400 + k * 2592000 as fecha_sys,
  {epoch_1995} + (c_custkey % 700) * 86400 + k * 2592000 as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {c} cross join (select 0 as k union all select 1 as k) kk
where k = 0 or c_custkey % 10 != 0"""
    q["zonas"] = f"""
select n_nationkey as codigo, cast(n_nationkey % 10 + 1 as double) as distancia,
  cast(100 + n_nationkey * 10 as decimal(10,2)) as precio, 20 + n_nationkey % 30 as demora,
  1 as activo, {epoch_1995} as fecha_sys, {epoch_1995} as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {d.t('nation')}"""
    label = d.pick(PRODUCT_LABELS, "p_size % 16")
    q["productos"] = f"""
select p_partkey as codigo, cast(substr(p_brand, 7) as int) as categoria,
  case when lbl in ('1 KG', '1 kg') then lbl else concat(lbl, ' ', p_name) end as nombre,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as descripcion,
  precio, round(precio * 0.90, 2) as precio_efectivo, precio as precio_mp,
  round(precio * 0.95, 2) as precio_transferencia, round(precio * 0.85, 2) as precio_alianza,
  round(precio * 0.80, 2) as precio_mostrador, round(precio * 0.72, 2) as precio_mostrador_efectivo,
  round(precio * 0.80, 2) as precio_mostrador_mp, round(precio * 0.76, 2) as precio_mostrador_transferencia,
  round(precio * 0.68, 2) as precio_mostrador_alianza,
  0 as descuento, 1 + p_size % 4 as gustos,
  cast(null as {'string' if d.name == 'spark' else 'varchar'}) as dias,
  case when p_partkey % 9 = 0 then 1 else 0 end as mostrador,
  case when p_partkey % 25 = 0 then 0 else 1 end as activo,
  {epoch_1995} as fecha_sys, {epoch_1995} as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from (select p.*, {label} as lbl, cast(p_retailprice as decimal(12,2)) as precio from {d.t('part')} p) x"""
    q["productos_categorias"] = f"""
select cast(substr(p_brand, 7) as int) as codigo, p_brand as nombre,
  cast(substr(p_brand, 7) as int) as orden, 1 as activo,
  {epoch_1995} as fecha_sys, {epoch_1995} as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {d.t('part')} group by p_brand"""
    q["sabores"] = f"""
select s_suppkey as codigo, s_nationkey % 5 + 1 as categoria,
  concat('Sabor ', {d.s('s_suppkey')}) as nombre,
  case when s_suppkey % 7 = 0 then 1 else 0 end as sinazucar,
  case when s_suppkey % 11 = 0 then 0 else 1 end as activo,
  {epoch_1995} as fecha_sys, {epoch_1995} as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {d.t('supplier')}"""
    q["sabores_categorias"] = f"""
select r_regionkey + 1 as codigo, r_name as nombre, r_regionkey as orden, 1 as activo,
  {epoch_1995} as fecha_sys, {epoch_1995} as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {d.t('region')}"""
    q["delivery"] = f"""
select o_orderkey as codigo,
  concat({d.s('o_orderkey')}, ',', {d.s('o_orderkey + 1')}) as pedidos,
  concat('rep', {d.s('o_orderkey % 5')}) as repartidor,
  cast(o_orderkey % 5 * 100 as decimal(12,2)) as total,
  case when o_orderstatus = 'F' then 3 else 2 end as estado, 1 as activo,
  {d.days('o_orderdate')} * 86400 as fecha_sys, {d.days('o_orderdate')} * 86400 as last_fecha_update,
  1 as admin_insert, cast(null as int) as last_admin_update
from {o} where o_orderkey % 3 = 0 and o_orderkey % 101 != 0"""
    # ---- seeds ----
    q["dolar_blue"] = f"""
select {d.date('o_orderdate')} as fecha,
  cast(800 + ({d.days('o_orderdate')} - 9131) * 0.35 + count(*) as decimal(10,2)) as valor_blue
from {o}
where {d.weekday('o_orderdate')} < 5
group by {d.date('o_orderdate')}, {d.days('o_orderdate')}"""
    q["clima_buenos_aires"] = f"""
select fecha,
  cast(12 + qq % 20 as double) as temp_max_c,
  cast(12 + qq % 20 - n % 8 - 2 as double) as temp_min_c,
  case when n % 3 = 0 then cast(n % 7 as double) * 1.5 else 0.0 end as precipitacion_mm,
  case when n % 3 = 0 then cast(n % 7 as double) * 1.5 else 0.0 end as lluvia_mm,
  cast(5 + (qq * 7) % 40 as double) as viento_max_kmh
from (select {d.date('l_shipdate')} as fecha, count(*) as n, cast(sum(l_quantity) as bigint) as qq
      from {li} group by {d.date('l_shipdate')}) x"""
    cat = d.pick(EXPENSE_CATEGORIES, "l_partkey % 16")
    means = d.pick(EXPENSE_MEANS, "l_suppkey % 6")
    q["egresos"] = f"""
select {d.date('l_shipdate')} as fecha,
  concat('gasto ', {d.s('l_orderkey')}, '-', {d.s('l_linenumber')}, '-', {d.s('l_suppkey')}) as descripcion,
  {cat} as categoria,
  round(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)), 2) as monto,
  'ARS' as moneda, {means} as medio_pago, cast(l_quantity as int) as cantidad
from {li}"""
    q["registro_diario_ventas"] = f"""
select dd.fecha, {d.dayname('dd.fecha')} as dia_nombre,
  cast(floor(coalesce(oo.n, 0) / 2) as int) + cast(day(dd.fecha) % 4 as int) as q_pedidos,
  cast((cast(floor(coalesce(oo.n, 0) / 2) as int) + day(dd.fecha) % 4) * 150 as decimal(12,2)) as total_rapiboys
from (select {d.date('l_shipdate')} as fecha from {li} group by {d.date('l_shipdate')}) dd
left join (select {d.date('o_orderdate')} as fecha, count(*) as n from {o} group by {d.date('o_orderdate')}) oo
  on dd.fecha = oo.fecha
where day(dd.fecha) % 9 != 0"""
    q["costos_sabores"] = f"""
select s_name as sabor_nombre,
  case when s_suppkey % 13 = 0 then null else {d.s('s_suppkey')} end as sabor_id,
  mm.mes, cast(1000 + (s_suppkey % 50) * 10 + mm.idx * 5 as decimal(10,2)) as costo_por_kg
from {d.t('supplier')} cross join (
  select {d.ym('o_orderdate')} as mes, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) as idx
  from {o} group by {d.ym('o_orderdate')}, (year(o_orderdate) - 1995) * 12 + month(o_orderdate)) mm
where s_suppkey % 5 != 0 and (s_suppkey + mm.idx) % 7 != 0 and mm.idx % 17 != 0"""
    q["puntos"] = f"""
select event_id as id, user_id + 1000 as cliente_id,
  case event_type when 'purchase' then cast(floor(value) as int)
                  when 'signup' then 50
                  when 'click' then cast(floor(value / 10) as int)
                  when 'error' then -cast(floor(value / 2) as int)
                  else 0 end as puntos,
  ts as fecha, {d.add_days(d.date('ts'), 'event_id % 60')} as vencimiento
from {d.t('events')}"""
    q["points_clientes"] = f"""
select user_id + 1000 as id, user_id as remote_id,
  concat('P', {d.s('user_id')}) as nombre, concat('p', {d.s('user_id')}, '@pts') as email
from {d.t('events')} where user_id % 10 != 9 group by user_id"""
    return q


RAW_TABLES = list(_raw_sql(DUCK).keys())

#: Raw tables grouped by a key with about as many values as rows: (test table, key) it is dealt by.
DEALT = {"pedidos_productos": ("lineitem", ["l_orderkey", "l_linenumber"])}


def raw_sql(engine: str = "duckdb") -> dict[str, str]:
    return _raw_sql(DUCK if engine == "duckdb" else SPARK)


class RawTables(Mapping):
    """All raw shop tables bound to the test tables under ``sf_dir``.

    A raw table is written as Parquet into the session's shared folder when it
    is first asked for, and scanned from there: consumers get column pruning,
    pushed filters and real sizes, as from a loaded source.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.root = input_root(spark, sf_dir, "raw")
        self._found: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._found:
            sql = _raw_sql(SPARK)[name]
            base = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet") for t in TEST_TABLES if "{" + t + "}" in sql}
            self._found[name] = materialise_once(lambda: self.spark.sql(sql, **self._dealt(name, base)), self.spark, f"{self.root}/{name}")
        return self._found[name]

    def _dealt(self, name: str, base: dict[str, DataFrame]) -> dict[str, DataFrame]:
        if name not in DEALT:
            return base
        table, keys = DEALT[name]
        return {**base, table: deal(base[table], keys, base[table].count())}

    def __iter__(self):
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)


def raw_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return RawTables(spark, sf_dir)
