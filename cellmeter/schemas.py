"""Message type names and the fixed schemas of inputs and results."""

from __future__ import annotations

# Message type names of the modem log.
DL_STAT = "LTE_PHY_PDSCH_Stat_Indication"
UL_REPORT = "LTE_PHY_PUSCH_Tx_Report"
UL_BUFFER = "LTE_MAC_UL_Buffer_Status_Internal"
CUSTOM = "Custom_Packet"
FIRST_TX = "First"

# Types each analysis subscribes to.
REQUIRED_TYPES = {
    "utilization": [DL_STAT],
    "uplink_latency": [UL_REPORT, UL_BUFFER],
}
KNOWN_TYPES = [DL_STAT, UL_REPORT, UL_BUFFER]

ENVELOPE = (
    "trace_id string, file_name string, msg_seq bigint, type_id string, ts timestamp"
)

RECORDS = (
    "array<struct<`Frame Num`:int, `Subframe Num`:int, `Num RBs`:int, "
    "`Current SFN SF`:int, `Re-tx Index`:string>>"
)

LCID = (
    "struct<`Total Bytes`:bigint, `New Compressed Bytes`:bigint, "
    "`Retx bytes`:bigint, `Ctrl bytes`:bigint>"
)
SAMPLE = f"struct<`Sub FN`:int, `Sys FN`:int, LCIDs:array<{LCID}>>"
SUBPACKETS = f"array<struct<Samples:array<{SAMPLE}>>>"

MESSAGES = f"{ENVELOPE}, Records {RECORDS}, Subpackets {SUBPACKETS}"

# One dict-text line: the timestamp is already epoch seconds.
TEXT_LINE = f"timestamp double, trace_id string, type_id string, Records {RECORDS}, Subpackets {SUBPACKETS}"
