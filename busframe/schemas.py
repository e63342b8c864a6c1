"""Fixed schemas of parsed tables and interface documents."""

from __future__ import annotations

_STATUS = ", ".join(f"statwrd{n} int, terminal{n} boolean, dynbusctrl{n} boolean, subsys{n} boolean, busy{n} boolean, bcastrcv{n} boolean, svcreq{n} boolean, instr{n} boolean, msgerr{n} boolean, status_rtaddr{n} tinyint" for n in (1, 2))

MILSTD1553 = (
    "time long, doy boolean, channelid int, ttb tinyint, WE boolean, SE boolean, WCE boolean, TO boolean, FE boolean, RR boolean, ME boolean, gap1 smallint, gap2 smallint, mode boolean, data array<int>, "
    "txcommwrd int, rxcommwrd int, txrtaddr tinyint, txtr boolean, txsubaddr tinyint, txwrdcnt tinyint, rxrtaddr tinyint, rxtr boolean, rxsubaddr tinyint, rxwrdcnt tinyint, totwrdcnt tinyint, calcwrdcnt tinyint, incomplete boolean, " + _STATUS
)
ARINC429 = "time long, doy boolean, channelid int, gaptime int, BS boolean, PE boolean, FE boolean, bus smallint, label smallint, SDI tinyint, data int, SSM tinyint, parity boolean"
ETHERNET = "time long, channelid int, payload array<smallint>, payload_sz long, dstmac string, srcmac string, ethtype int, llcfmt smallint, llcdsap smallint, llcssap smallint, llcsndseqnum smallint, llcrcvseqnum smallint, dstip string, srcip string, ipid int, ipproto smallint, ipoffset int, dstport int, srcport int"
VIDEO = "doy boolean, ET boolean, IPH boolean, KLV boolean, PL smallint, SRS boolean, data array<int>, time long, channelid int"
TIME_FIXES = "time long, src tinyint, time_fmt tinyint, leap_yr boolean, date_fmt boolean"
PACKETS = "file string, offset long, channelid int, pkt_size long, data_size long, data_type_ver int, seq_num int, checksum_existence int, time_format int, overflow_err boolean, sync_err boolean, intrapkt_ts_source int, secondary_hdr int, data_type int, rtc long, sec_time binary, sec_ok boolean, checksum_ok boolean, body binary"
#: The clock fix that holds for a packet.
FIX = "fix_offset long, fix_rtc long, fix_time long, doy boolean"
ICD_1553 = "msg_name string, elem_name string, xmit_word int, dest_word int, msg_word_count int, bus_name string, xmit_lru_name string, xmit_lru_addr int, dest_lru_name string, dest_lru_addr int, xmit_lru_subaddr int, dest_lru_subaddr int, rate float, offset int, elem_word_count int, schema string, is_bitlevel boolean, is_multiformat boolean, bitmsb int, bitlsb int, bit_count int, classification int, description string, msb_val double, uom string"
ICD_429 = "word_name string, elem_name string, label int, bus string, sdi int, rate double, lru_name string, schema string, bitmsb int, bitlsb int, bit_count int, bcd_partial int, msb_val double, description string, uom string, classification int"
MESSAGE_KEYS = "key long, bus string"
TMATS = "channelid int, source string, type string"

#: Columns that translation reads.
READ_1553 = ["time", "data", "channelid", "txrtaddr", "rxrtaddr", "txsubaddr", "rxsubaddr"]
READ_429 = ["time", "channelid", "bus", "label", "SDI", "data", "SSM", "parity"]
