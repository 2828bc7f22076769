"""Vocabulary shared by every module: classes, column groups, feature names.

All literals here are fixed values: results depend on them, so they are stated
once, in their natural order, and imported everywhere else.
"""

# Traffic classes, coded by position.
CLASSES = ["Normal traffic", "Suspicious traffic", "DDoS attack"]
NORMAL, SUSPICIOUS, DDOS = 0, 1, 2

# Which source sets make up each split.
SPLIT_SETS = {"train": ["SetA", "SetB"], "test": ["SetC"], "genericity": ["SetD"]}

# Tokens of the multi-label attack code.
ATTACK_TOKENS = [
    "SYN Attack", "DNS", "NTP", "Generic UDP", "High volume traffic",
    "Suspicious traffic", "CLDAP", "SSDP", "memcached",
]

# Ordered substring rules for the family of an attack code.
FAMILY_RULES = [
    ("syn", "SYN Flood"), ("dns", "DNS Amplification"),
    ("ntp", "NTP Amplification"), ("udp", "UDP Flood"),
]
FAMILIES = [name for _, name in FAMILY_RULES] + ["Other"]

# Columns whose outliers are capped, and the quantile of the cap.
EVENT_CAP_COLUMNS = [
    "packet_speed", "data_speed", "avg_packet_len", "avg_source_ip_count", "detect_count",
]
COMPONENT_CAP_COLUMNS = ["packet_speed", "data_speed", "avg_packet_len", "source_ip_count"]
CAP_QUANTILE = 0.99

# Port groups.
DNS_PORTS = [53]
AMPLIFICATION_PORTS = [19, 123, 161, 389, 1900, 3702, 5683, 11211]
HTTP_PORTS = [80, 8080]
HTTPS_PORTS = [443, 8443]
FIRST_EPHEMERAL_PORT = 32768

# Feature names and their order in the model input.
PORT_FEATURES = [
    "is_port_zero", "is_port_dns", "is_amplification_port",
    "is_http_port", "is_https_port", "is_ephemeral_port",
]
FEATURES_AB = [
    "pps_mean", "pps_max", "pps_p95", "pps_std",
    "pps_burstiness", "pps_cv", "pps_skew_proxy",
    "bytes_per_pkt_mean", "bytes_per_pkt_max", "bytes_per_pkt_min",
    "bytes_per_pkt_range", "bytes_to_pkts_ratio",
    "src_ip_mean", "src_ip_max", "src_ip_std",
] + PORT_FEATURES
FEATURES_BASE = [
    "pps_mean", "pps_max", "pps_p95", "pps_std", "pps_burstiness",
    "bytes_per_pkt_mean", "bytes_per_pkt_max", "bytes_per_pkt_min", "bps_estimate",
    "src_ip_mean", "src_ip_max", "src_ip_std",
] + PORT_FEATURES
FEATURES_EXTRA = [
    "n_components", "log1p_n_components", "is_single_sample",
    "pps_median_log", "pps_mad_log", "bytes_per_pkt_median", "bytes_per_pkt_mad",
]
FEATURES_V1 = [
    "packet_speed", "data_speed", "avg_packet_len",
    "avg_source_ip_count", "detect_count", "port",
]
FEATURES_OOD = ["gmm_max_prob", "gmm_entropy"]

# The numeric columns the exploratory reports look at.
PROFILE_COLUMNS = [
    "packet_speed", "data_speed", "avg_packet_len", "avg_source_ip_count", "detect_count",
]

# Classifiers in report order, and the class prior of the genericity split.
MODELS = [
    "Logistic Regression", "Decision Tree", "Random Forest", "KNN (k=5)", "Gradient Boosting",
]
TARGET_PRIOR = {0: 0.9014, 1: 0.0649, 2: 0.0337}
MACRO = "__macro__"
