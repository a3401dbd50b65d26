"""D01 identity resolution: customer -> identity id (e-mail first, then phone).

Groups, disjoint and covering every customer:
  email         customers with a non-empty e-mail; id = dense rank of the e-mail (1, 2, ...)
  phone_bridge  no e-mail, but their phone is used by an e-mail customer;
                inherit the lowest such e-mail id
  phone_only    no e-mail, no bridge, a phone; id = -(dense rank of the phone)
  sin_identidad nothing to go by; id null
A customer's phone is its own trimmed phone, else the most frequent phone on
its orders (catch-all customers excluded from that fallback).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.aggregates import mode_per_key
from conewise.operators.rank import global_row_number
from conewise.sources.sinks import cut_lineage

IDENTITY_COLUMNS = ["cliente_id_mail_phone", "id_mail", "id_phone", "tipo_identidad", "cliente_id",
                    "email", "telefono", "nombre", "is_activo", "created_at"]


def unified_phones(clientes: DataFrame, pedidos: DataFrame,
                   catch_all=R.CATCH_ALL_CUSTOMERS) -> DataFrame:
    """Customer phone: own trimmed phone, else the mode of its order phones."""
    own = clientes.filter(C.not_blank("telefono")).select(
        "cliente_id", F.trim("telefono").alias("_own"))
    used = pedidos.filter(C.not_blank("telefono") & ~F.col("cliente_id").isin(list(catch_all))).select(
        "cliente_id", F.trim("telefono").alias("telefono"))
    mode = mode_per_key(used, "cliente_id", "telefono", "_ord")
    return (clientes.select("cliente_id")
            .join(own, "cliente_id", "left")
            .join(mode, "cliente_id", "left")
            .select("cliente_id", F.coalesce("_own", "_ord").alias("telefono")))


def resolve_identity(clientes: DataFrame, pedidos: DataFrame,
                     catch_all=R.CATCH_ALL_CUSTOMERS) -> DataFrame:
    phones = unified_phones(clientes, pedidos, catch_all)
    has_email = F.col("email").isNotNull() & (F.col("email") != "")
    # one row per customer, read by every branch below: cut once
    cu = cut_lineage(clientes.select("cliente_id", "email", "nombre", "is_activo", "created_at")
                     .join(phones, "cliente_id", "left")
                     .withColumn("_has_email", F.coalesce(has_email, F.lit(False))))

    with_email = cu.filter("_has_email")
    no_email = cu.filter(~F.col("_has_email"))
    has_phone = F.col("telefono").isNotNull()
    # Phones that need an id of their own (no e-mail, phone not used by any
    # e-mail customer) do not depend on the e-mail ids, so e-mails and those
    # phones are numbered in ONE distributed rank over (kind, key): e-mails
    # first (kind 0, id = rank), then phones (kind 1, id = -(rank - #e-mails)).
    mail_phones = with_email.filter(has_phone).select("telefono").distinct()
    keys = (with_email.select(F.lit(0).alias("_kind"), F.col("email").alias("_key")).distinct()
            .unionByName(no_email.filter(has_phone).join(mail_phones, "telefono", "left_anti")
                         .select(F.lit(1).alias("_kind"), F.col("telefono").alias("_key")).distinct()))
    ranked = global_row_number(keys, [F.col("_kind").asc(), F.col("_key").asc()], "_rn")
    n_mail = ranked.agg(F.count_if(F.col("_kind") == 0).alias("_n_mail"))  # one row
    emails = ranked.filter(F.col("_kind") == 0).select(F.col("_key").alias("email"), F.col("_rn").alias("id_mail"))
    phone_ids = (ranked.filter(F.col("_kind") == 1).crossJoin(F.broadcast(n_mail))
                 .select(F.col("_key").alias("telefono"), (F.col("_n_mail") - F.col("_rn")).alias("_pid")))
    email_group = with_email.join(emails, "email")

    # one row per phone (lowest e-mail id) before joining: no fan-out even
    # when many e-mail identities share one phone
    phone_to_mail = (email_group.filter(has_phone)
                     .groupBy("telefono").agg(F.min("id_mail").alias("_bridge")))
    # bridge or own phone id in left joins (no join + anti-join + union chain)
    rest = no_email.join(phone_to_mail, "telefono", "left").join(phone_ids, "telefono", "left")

    null_long = F.lit(None).cast("bigint")
    null_str = F.lit(None).cast("string")
    tail = ["nombre", "is_activo", "created_at"]
    g1 = email_group.select(F.col("id_mail").alias("cliente_id_mail_phone"), "id_mail",
                            null_long.alias("id_phone"), F.lit("email").alias("tipo_identidad"),
                            "cliente_id", "email", "telefono", *tail)
    bridged = F.col("_bridge").isNotNull()
    g2 = rest.select(
        F.coalesce("_bridge", "_pid").alias("cliente_id_mail_phone"),
        F.col("_bridge").alias("id_mail"),
        F.col("_pid").alias("id_phone"),
        F.when(bridged, "phone_bridge").when(F.col("_pid").isNotNull(), "phone_only")
         .otherwise("sin_identidad").alias("tipo_identidad"),
        "cliente_id", null_str.alias("email"), "telefono", *tail)
    return g1.unionByName(g2)
