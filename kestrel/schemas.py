"""Declared schemas and presets.  Schemas are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_F = T.FloatType()
_L = T.LongType()
_S = T.StringType()

# The connection-log (KDD Cup 99) field names and types, in file
# order.  They must equal the source data layout for positional CSV parsing.
CONNECTION_FIELDS: list[tuple[str, T.DataType]] = [
    ("duration", _F), ("protocol_type", _S), ("service", _S), ("flag", _S),
    ("src_bytes", _F), ("dst_bytes", _F), ("land", _F), ("wrong_fragment", _F),
    ("urgent", _F), ("hot", _F), ("num_failed_logins", _F), ("logged_in", _F),
    ("num_compromised", _F), ("root_shell", _F), ("su_attempted", _F),
    ("num_root", _L), ("num_file_creations", _L), ("num_shells", _L),
    ("num_access_files", _L), ("num_outbound_cmds", _L),
    ("is_host_login", _F), ("is_guest_login", _F), ("count", _L), ("srv_count", _L),
    ("serror_rate", _F), ("srv_serror_rate", _F), ("rerror_rate", _F),
    ("srv_rerror_rate", _F), ("same_srv_rate", _F), ("diff_srv_rate", _F),
    ("srv_diff_host_rate", _F), ("dst_host_count", _F), ("dst_host_srv_count", _F),
    ("dst_host_same_srv_rate", _F), ("dst_host_diff_srv_rate", _F),
    ("dst_host_same_src_port_rate", _F), ("dst_host_srv_diff_host_rate", _F),
    ("dst_host_serror_rate", _F), ("dst_host_srv_serror_rate", _F),
    ("dst_host_rerror_rate", _F), ("dst_host_srv_rerror_rate", _F),
    ("attack", _S),
]


def struct_of(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONNECTION_SCHEMA = struct_of(CONNECTION_FIELDS)

# Stream message: the 41 features, then the producer's bucket number.
STREAM_FIELDS = CONNECTION_FIELDS[:41] + [("time_stamp", T.IntegerType())]
STREAM_SCHEMA = struct_of(STREAM_FIELDS)
FEATURE_FIELDS = CONNECTION_FIELDS[:41]

# Stage-timing ledger (file_name, function_name, description, time_taken).
LEDGER_FIELDS = [("file_name", _S), ("function_name", _S), ("description", _S),
                 ("time_taken", T.DoubleType())]
LEDGER_SCHEMA = struct_of(LEDGER_FIELDS)

# Label -> category map of the connection log, as written in
# the surveyed code (including its misspelt "loadmdoule").
ATTACK_CATEGORIES: dict[str, list[str]] = {
    "dos_attacks": ["apache2", "back", "land", "neptune", "mailbomb", "pod",
                    "processtable", "smurf", "teardrop", "udpstorm", "worm"],
    "probe_attacks": ["ipsweep", "mscan", "nmap", "portsweep", "saint", "satan"],
    "privilege_attacks": ["buffer_overflow", "loadmdoule", "perl", "ps", "rootkit",
                          "sqlattack", "xterm"],
    "access_attacks": ["ftp_write", "guess_passwd", "http_tunnel", "imap", "multihop",
                       "named", "phf", "sendmail", "snmpgetattack", "snmpguess", "spy",
                       "warezclient", "warezmaster", "xclock", "xsnoop"],
    "normal": ["normal"],
}

# Same map with the label spelt as it appears in the data.
ATTACK_CATEGORIES_FIXED = {
    k: [("loadmodule" if v == "loadmdoule" else v) for v in vs]
    for k, vs in ATTACK_CATEGORIES.items()
}

# Rare labels removed by the second ETL generation.
RARE_ATTACKS = ["perl", "multihop", "spy", "ftp_write", "loadmodule", "phf"]

# The three categories a relabelled majority row may receive.
RELABEL_TARGETS = ["privilege_attacks", "probe_attacks", "access_attacks"]
