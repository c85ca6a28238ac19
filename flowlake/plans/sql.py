"""Equivalent SQL for the adapters: the same flow records, clean rows and features, as common table
expressions for a plain SQL engine."""

from __future__ import annotations

FEATURES = ["traffic_asymmetry_ratio", "pkt_size_cv", "flow_intensity", "iat_regularity", "conn_efficiency"]

NUMERIC = [
    "tcp_ack", "tcp_seq", "tcp_len", "tcp_flags", "tcp_checksum", "tcp_connection_syn", "tcp_connection_fin",
    "tcp_connection_rst", "tcp_srcport", *FEATURES,
]


def guard(x: str, default: str = "0.0") -> str:
    return f"case when ({x}) is null or isnan({x}) or isinf({x}) then {default} else ({x}) end"


def draw(key: str, seed: int) -> str:
    """Uniform integer in [0, 2^32) from the MD5 of key and seed."""
    return f"cast(('0x' || substr(md5(concat_ws('|', cast({key} as varchar), '{seed}')), 1, 8)) as bigint)"


_FLOWS = """
f as (
  select l_orderkey * 10 + l_linenumber as flow_key, l_shipdate as event_time,
    case when l_partkey % 61 = 0 then 'n/a'
         else cast((l_orderkey * 37 + l_linenumber * 3607) % 864000 as varchar) end as frame_time,
    case when l_partkey % 53 = 0 then cast(null as double)
         when l_partkey % 89 = 0 then cast('NaN' as double)
         when l_partkey % 97 = 0 then cast('Infinity' as double)
         when l_partkey % 101 = 0 then cast('-Infinity' as double)
         else l_extendedprice end as tcp_ack,
    case when l_quantity = 50 then cast(-1 as double) else l_quantity end as tcp_seq,
    case when l_partkey % 47 = 0 then cast(null as double) else round(l_tax * 1000) end as tcp_len,
    cast(l_linenumber as double) as tcp_flags, cast(l_suppkey as double) as tcp_checksum,
    cast(l_partkey % 2 as double) as tcp_connection_syn,
    case when l_returnflag = 'R' then cast(1 as double) else cast(0 as double) end as tcp_connection_fin,
    case when l_linestatus = 'F' then cast(1 as double) else cast(0 as double) end as tcp_connection_rst,
    case when l_partkey % 59 = 0 then 'n/a' else cast(1024 + l_partkey % 60000 as varchar) end as tcp_srcport,
    case when l_suppkey % 13 = 0 then cast(null as varchar)
         else concat('10.0.0.', cast(l_suppkey % 256 as varchar)) end as source_ip,
    concat('10.0.1.', cast(l_linenumber as varchar)) as dest_ip,
    case when kind <= 3 then 'Normal' when kind = 4 then 'DDoS_UDP'
         when kind = 5 then 'Port_Scanning' when kind = 6 then 'Ransomware'
         else 'MITM' end as Attack_type,
    case when kind <= 3 then 0 else 1 end as Attack_label
  from (select *, case when noise % 8 = 0 then (noise & 1792) // 256 when l_returnflag = 'R' and l_quantity > 25 then 7
          when l_partkey % 5 = 0 then least(l_linenumber + 2, 7) else l_linenumber end as kind
        from (select *, ('0x' || substr(md5(cast(l_orderkey * 10 + l_linenumber as varchar)), 1, 4))::integer as noise from lineitem))
),
flows as (select * from f union all select * from f where flow_key % 17 = 0)
"""

_RAW = """,
raw as (
  select *, cast(flow_key % 3 as double) as arp_opcode,
    case when source_ip is null then concat('192.168.0.', cast(flow_key % 200 as varchar)) end as arp_src,
    cast(flow_key % 7 as double) as icmp_checksum,
    case when flow_key % 4 = 0 then cast(flow_key % 50000 as varchar) end as tcp_dstport
  from flows
)
"""

_PLAIN = ["tcp_seq", "tcp_flags", "tcp_checksum", "tcp_connection_syn", "tcp_connection_fin", "tcp_connection_rst"]

_CLEAN = f""",
clean as (
  select distinct flow_key, event_time, frame_time, {guard("tcp_ack")} as tcp_ack, {", ".join(_PLAIN)},
    coalesce(tcp_len, 0.0) as tcp_len,
    coalesce(cast(trunc(try_cast(tcp_srcport as double)) as integer), 0) as tcp_srcport,
    coalesce(source_ip, 'unknown') as source_ip, dest_ip, Attack_type, Attack_label
  from flows
)
"""

FORMULAS = {
    "traffic_asymmetry_ratio": "tcp_ack / nullif(tcp_seq + 1, 0)",
    "pkt_size_cv": "tcp_len / nullif(abs(tcp_seq - tcp_ack) + 1, 0)",
    "flow_intensity": "tcp_len * tcp_flags",
    "iat_regularity": "tcp_checksum / nullif(tcp_len + 1, 0)",
    "conn_efficiency": "tcp_connection_syn / nullif(tcp_connection_fin + tcp_connection_rst + 1, 0)",
}

_GOLD = ",\ngold as (select *, " + ",\n".join(f"{guard(x)} as {n}" for n, x in FORMULAS.items()) + " from clean)\n"


def with_flows(body: str) -> str:
    return f"with {_FLOWS} {body}"


def with_raw(body: str) -> str:
    return f"with {_FLOWS} {_RAW} {body}"


def with_clean(body: str) -> str:
    return f"with {_FLOWS} {_CLEAN} {body}"


def with_gold(body: str) -> str:
    return f"with {_FLOWS} {_CLEAN} {_GOLD} {body}"


def union(parts) -> str:
    return "\nunion all\n".join(parts)
