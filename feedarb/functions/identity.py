"""Which machine stands behind a source name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cloud's provider id form and the node name form.
PROVIDER_PATTERN = r"^aws://[^/]*/[^/]*/(i-[0-9a-f]+)$"
NODE_NAME_PATTERN = r"^ip-(\d{1,3})-(\d{1,3})-(\d{1,3})-(\d{1,3})(?:\.|$)"


def instance_of_provider(provider_id: Column) -> Column:
    return F.nullif(F.regexp_extract(provider_id, PROVIDER_PATTERN, 1), F.lit(""))


def ip_of_node_name(name: Column) -> Column:
    """Private address written in a node name; null if an octet exceeds 255."""
    octets = [F.regexp_extract(name, NODE_NAME_PATTERN, i).try_cast("int") for i in range(1, 5)]
    address = F.concat_ws(".", *octets)
    return F.when(
        name.rlike(NODE_NAME_PATTERN) & (F.greatest(*octets) <= 255), address
    )


def node_identity(provider_id: Column, name: Column) -> Column:
    """struct(instance_id, private_ip): the provider id wins, else the address."""
    instance = instance_of_provider(provider_id)
    return F.struct(
        instance.alias("instance_id"),
        F.when(instance.isNull(), ip_of_node_name(name)).alias("private_ip"),
    )
