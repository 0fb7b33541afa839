"""Fixed vocabulary of the flow model: features, classes, severities, spellings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Feature(NamedTuple):
    """One model input; its place in ``FEATURES`` is its place in the vector."""

    key: str  # JSON heading
    column: str  # column name
    kind: str  # Spark type: int, bigint or double
    alias: str | None  # heading used by the traffic generator, where it has one
    mean: float  # trained scaler mean
    scale: float  # trained scaler standard deviation


# The 52 inputs of the trained classifier in vector order, with the
# constants its scaler was fitted to (float32 literals).
FEATURES: tuple[Feature, ...] = (
    Feature("Destination Port", "destinationPort", "int", None, 8689.052167013786, 19010.376992049456),
    Feature("Flow Duration", "flowDuration", "bigint", "flowDuration", 16597308.277458098, 35236624.52081067),
    Feature("Total Fwd Packets", "totalFwdPackets", "int", "totalFwdPackets", 10.761854110879698, 849.1322036679996),
    Feature("Total Length of Fwd Packets", "totalLengthOfFwdPackets", "bigint", "totalLengthFwdPackets", 609.5361008628385, 10894.937311310225),
    Feature("Fwd Packet Length Max", "fwdPacketLengthMax", "int", "fwdPacketLengthMax", 231.37130665476545, 756.9868638009714),
    Feature("Fwd Packet Length Min", "fwdPacketLengthMin", "int", "fwdPacketLengthMin", 19.221296241198058, 61.05588314253914),
    Feature("Fwd Packet Length Mean", "fwdPacketLengthMean", "double", "fwdPacketLengthMean", 63.53224522047419, 195.73162075194148),
    Feature("Fwd Packet Length Std", "fwdPacketLengthStd", "double", "fwdPacketLengthStd", 77.33448893851943, 296.83454719314057),
    Feature("Bwd Packet Length Max", "bwdPacketLengthMax", "int", "bwdPacketLengthMax", 974.2384538331846, 2036.4337001942754),
    Feature("Bwd Packet Length Min", "bwdPacketLengthMin", "int", "bwdPacketLengthMin", 43.15323911534266, 70.90742160472638),
    Feature("Bwd Packet Length Mean", "bwdPacketLengthMean", "double", "bwdPacketLengthMean", 340.48780949980863, 632.29094180864),
    Feature("Bwd Packet Length Std", "bwdPacketLengthStd", "double", "bwdPacketLengthStd", 376.21607912381876, 880.2308754810773),
    Feature("Flow Bytes/s", "flowBytesPerS", "double", "flowBytesPerSec", 1399374.9547844238, 26299831.285405077),
    Feature("Flow Packets/s", "flowPacketsPerS", "double", "flowPacketsPerSec", 47227.0587095069, 202423.14703624093),
    Feature("Flow IAT Mean", "flowIATMean", "double", "flowIATMean", 1446494.505382718, 4679301.054615396),
    Feature("Flow IAT Std", "flowIATStd", "double", "flowIATStd", 3280272.338091009, 8459445.193997132),
    Feature("Flow IAT Max", "flowIATMax", "bigint", "flowIATMax", 10304639.213672519, 25691216.070817526),
    Feature("Flow IAT Min", "flowIATMin", "bigint", "flowIATMin", 169751.60313745908, 3005918.8416812452),
    Feature("Fwd IAT Total", "fwdIATTotal", "bigint", "fwdIATTotal", 16258052.576984033, 35170700.055525474),
    Feature("Fwd IAT Mean", "fwdIATMean", "double", "fwdIATMean", 2920651.110117461, 10019910.533876188),
    Feature("Fwd IAT Std", "fwdIATStd", "double", "fwdIATStd", 3670273.509170604, 10142745.379341973),
    Feature("Fwd IAT Max", "fwdIATMax", "bigint", "fwdIATMax", 10148409.682661906, 25772530.990048345),
    Feature("Fwd IAT Min", "fwdIATMin", "bigint", "fwdIATMin", 1136181.5511727661, 9063215.722722372),
    Feature("Bwd IAT Total", "bwdIATTotal", "bigint", "bwdIATTotal", 11114804.234260637, 30234263.98368817),
    Feature("Bwd IAT Mean", "bwdIATMean", "double", "bwdIATMean", 2030855.1821837707, 9404498.286608748),
    Feature("Bwd IAT Std", "bwdIATStd", "double", "bwdIATStd", 1670402.3188223485, 6635106.603072663),
    Feature("Bwd IAT Max", "bwdIATMax", "bigint", "bwdIATMax", 5264953.967778439, 18109951.143324655),
    Feature("Bwd IAT Min", "bwdIATMin", "bigint", "bwdIATMin", 1087845.3555876226, 8805973.446530607),
    Feature("Fwd Header Length", "fwdHeaderLength", "bigint", "fwdHeaderLength", -34831.38879797679, 24885567.32103977),
    Feature("Bwd Header Length", "bwdHeaderLength", "bigint", "bwdHeaderLength", -2591.9069567589013, 1542106.3376589427),
    Feature("Fwd Packets/s", "fwdPacketsPerS", "double", "fwdPacketsPerSec", 40808.41482644931, 193179.0661797171),
    Feature("Bwd Packets/s", "bwdPacketsPerS", "double", "bwdPacketsPerSec", 6498.646527809006, 37833.028659381795),
    Feature("Min Packet Length", "minPacketLength", "int", "minPacketLength", 16.827277595953586, 25.529648447893962),
    Feature("Max Packet Length", "maxPacketLength", "int", "maxPacketLength", 1063.0635832589508, 2120.0784396052327),
    Feature("Packet Length Mean", "packetLengthMean", "double", "packetLengthMean", 190.5952517625845, 318.2759546398059),
    Feature("Packet Length Std", "packetLengthStd", "double", "packetLengthStd", 329.98240151197524, 660.4201696304931),
    Feature("Packet Length Variance", "packetLengthVariance", "double", "packetLengthVariance", 545012.8516209299, 1735096.143033614),
    Feature("FIN Flag Count", "finFlagCount", "int", "FINFlagCount", 0.03207775463651691, 0.17620661819011318),
    Feature("PSH Flag Count", "pshFlagCount", "int", "PSHFlagCount", 0.2977114945948626, 0.4572519661859922),
    Feature("ACK Flag Count", "ackFlagCount", "int", "ACKFlagCount", 0.31186303679460475, 0.4632542315790022),
    Feature("Average Packet Size", "averagePacketSize", "double", "averagePacketSize", 212.35602201957437, 345.3755807288352),
    Feature("Subflow Fwd Bytes", "subflowFwdBytes", "bigint", None, 609.5213919468412, 10877.52835949104),
    Feature("Init_Win_bytes_forward", "initWinBytesForward", "bigint", None, 7266.7838936824355, 14599.981111059698),
    Feature("Init_Win_bytes_backward", "initWinBytesBackward", "bigint", None, 2231.265810770604, 8930.964601045935),
    Feature("act_data_pkt_fwd", "actDataPktFwd", "int", None, 6.262323713180601, 711.6881278440771),
    Feature("min_seg_size_forward", "minSegSizeForward", "bigint", None, -3202.0918838639295, 1164532.808227276),
    Feature("Active Mean", "activeMean", "double", None, 91790.59588807708, 683881.2341816695),
    Feature("Active Max", "activeMax", "bigint", None, 172163.15410691264, 1079997.7622263255),
    Feature("Active Min", "activeMin", "bigint", None, 65683.88400823167, 610376.6308804388),
    Feature("Idle Mean", "idleMean", "double", None, 9342584.356650768, 24856124.154962275),
    Feature("Idle Max", "idleMax", "bigint", None, 9768383.411415253, 25623406.887789164),
    Feature("Idle Min", "idleMin", "bigint", None, 8898852.464385599, 24590423.466968883),
)

# Output classes of the classifier; the position is the class index.
CLASSES: tuple[str, ...] = (
    "Bots",
    "Brute Force",
    "DDoS",
    "DoS",
    "Normal Traffic",
    "Port Scanning",
    "Web Attacks",
)

NORMAL = "Normal Traffic"
UNKNOWN_LABEL = "Unknown"
UNKNOWN_HOST = "unknown"

# Severity of an alert by class; every other label is UNKNOWN.
SEVERITIES: dict[str, str] = {
    "DDoS": "HIGH",
    "DoS": "HIGH",
    "Brute Force": "MEDIUM",
    "Web Attacks": "MEDIUM",
    "Bots": "LOW",
    "Port Scanning": "LOW",
}
UNKNOWN_SEVERITY = "UNKNOWN"

# Spelling of the ground-truth labels in generated traffic -> model class.
TRAFFIC_LABELS: dict[str, str] = {
    "Normal": "Normal Traffic",
    "DoS": "DoS",
    "DDoS": "DDoS",
    "PortScan": "Port Scanning",
    "BruteForce": "Brute Force",
    "WebAttack": "Web Attacks",
    "Botnet": "Bots",
}

# Thresholds of the detection and scoring jobs.
ALERT_THRESHOLD = 0.5
SESSION_THRESHOLD = 0.8

# Fixed value: key prefix of the stored counts.
COUNT_PREFIX = "click_count:"

N_FEATURES = len(FEATURES)
N_CLASSES = len(CLASSES)
COLUMNS: tuple[str, ...] = tuple(f.column for f in FEATURES)
MEANS: tuple[float, ...] = tuple(f.mean for f in FEATURES)
SCALES: tuple[float, ...] = tuple(f.scale for f in FEATURES)

_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}

# Header of the training CSV: the JSON headings plus the label column.
LABEL_COLUMN = "Attack Type"
TRAINING_SCHEMA = T.StructType(
    [T.StructField(f.key, _TYPES[f.kind]) for f in FEATURES]
    + [T.StructField(LABEL_COLUMN, T.StringType())]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("destination_port", T.IntegerType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField(
            "all_probabilities",
            T.StructType([T.StructField(c, T.DoubleType()) for c in CLASSES]),
        ),
        T.StructField("flow_duration", T.LongType()),
        T.StructField("total_fwd_packets", T.IntegerType()),
        T.StructField("severity", T.StringType()),
    ]
)

UI_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("element_id", T.StringType()),
        T.StructField("input_hash", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("device_fingerprint", T.StringType()),
        T.StructField("ip", T.StringType()),
    ]
)
