"""A small encoder of captures: packets of DNS and ICMP traffic, made from plain values."""

import struct
from ipaddress import ip_address

CLIENT, SERVER = "192.0.2.10", "198.51.100.53"


def name(text: str) -> bytes:
    if text == ".":
        return b"\0"
    return b"".join(bytes([len(x)]) + x for x in (p.encode("latin-1") for p in text.rstrip(".").split("."))) + b"\0"


def option(code: int, data: bytes) -> bytes:
    return struct.pack(">HH", code, len(data)) + data


def dns(ident=1, response=False, qname="example.nl.", qtype=1, rcode=0, opcode=0, opt=None, udp=1232, question=True, flags=0) -> bytes:
    bits = (0x8000 if response else 0) | opcode << 11 | rcode | flags
    out = struct.pack(">6H", ident, bits, int(question), 0, 0, int(opt is not None))
    if question:
        out += name(qname) + struct.pack(">HH", qtype, 1)
    if opt is not None:
        out += b"\0" + struct.pack(">HHIH", 41, udp, 0x8000, len(opt)) + opt
    return out


def ip(body: bytes, prot: int, src=CLIENT, dst=SERVER, ttl=64, df=False, ident=1, offset=0, more=False) -> bytes:
    a, b = ip_address(src), ip_address(dst)
    if a.version == 4:
        frag = (0x4000 if df else 0) | (0x2000 if more else 0) | offset // 8
        return struct.pack(">BBHHHBBH", 0x45, 0, 20 + len(body), ident, frag, ttl, prot, 0) + a.packed + b.packed + body
    return struct.pack(">IHBB", 6 << 28, len(body), prot, ttl) + a.packed + b.packed + body


def udp(data: bytes, sport=40000, dport=53) -> bytes:
    return struct.pack(">HHHH", sport, dport, 8 + len(data), 0) + data


def tcp(data: bytes, seq: int, sport=40000, dport=53, flags=16, options=b"") -> bytes:
    return struct.pack(">HHIIBBHHH", sport, dport, seq, 1, (5 + len(options) // 4) << 4, flags, 1024, 0, 0) + options + data


def framed(*messages: bytes) -> bytes:
    return b"".join(struct.pack(">H", len(m)) + m for m in messages)


def pcap(packets, link=101, header=True) -> bytes:
    """``packets``: (ms, IP packet)"""
    out = [struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, link)] if header else []
    for ms, p in packets:
        p = b"\0" * 12 + (b"\x08\x00" if p[0] >> 4 == 4 else b"\x86\xdd") + p if link == 1 else p
        out += struct.pack("<IIII", ms // 1000, ms % 1000 * 1000, len(p), len(p)), p
    return b"".join(out)


def query(ms, ident=1, sport=40000, **kw):
    return ms, ip(udp(dns(ident, **kw), sport), 17)


def answer(ms, ident=1, sport=40000, **kw):
    return ms, ip(udp(dns(ident, response=True, **kw), 53, sport), 17, SERVER, CLIENT)
