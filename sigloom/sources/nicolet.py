"""Nicolet .e files: a tag table, a chain of section indexes, packets of metadata, and 16-bit samples by section."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import from_arrow_schema

from sigloom.sources.base import BATCH, Format, Piece, event_batch, list_files, read_at, sample_batch, split

#: Fixed values of the format.
TAGS_AT, QI_AT, PACKET, SEGMENT, SIGNALS = 172, 172_208, 48, 152, 552
TS_PACKET = "{A271CCCB-515D-4590-B6A1-DC170C8D6EE2}"
#: Names of the kinds of sections and packets.
SECTION_NAMES = {
    "{A271CCCB-515D-4590-B6A1-DC170C8D6EE2}": "TSGUID",
    "{8A19AA48-BEA0-40D5-B89F-667FC578D635}": "DERIVATIONGUID",
    "{F824D60C-995E-4D94-9578-893C755ECB99}": "FILTERGUID",
    "{02950361-35BB-4A22-9F0B-C78AAA5DB094}": "DISPLAYGUID",
    "{8E94EF21-70F5-11D3-8F72-00105A9AFD56}": "FILEINFOGUID",
    "{E4138BC0-7733-11D3-8685-0050044DAAB1}": "SRINFOGUID",
    "{C728E565-E5A0-4419-93D2-F6CFC69F3B8F}": "EVENTTYPEINFOGUID",
    "{D01B34A0-9DBD-11D3-93D3-00500400C148}": "AUDIOINFOGUID",
    "{BF7C95EF-6C3B-4E70-9E11-779BFFF58EA7}": "CHANNELGUID",
    "{2DEB82A1-D15F-4770-A4A4-CF03815F52DE}": "INPUTGUID",
    "{5B036022-2EDC-465F-86EC-C0A4AB1A7A91}": "INPUTSETTINGSGUID",
    "{99A636F2-51F7-4B9D-9569-C7D45058431A}": "PHOTICGUID",
    "{55C5E044-5541-4594-9E35-5B3004EF7647}": "ERRORGUID",
    "{223A3CA0-B5AC-43FB-B0A8-74CF8752BDBE}": "VIDEOGUID",
    "{0623B545-38BE-4939-B9D0-55F5E241278D}": "DETECTIONPARAMSGUID",
    "{CE06297D-D9D6-4E4B-8EAC-305EA1243EAB}": "PAGEGUID",
    "{782B34E8-8E51-4BB9-9701-3227BB882A23}": "ACCINFOGUID",
    "{3A6E8546-D144-4B55-A2C7-40DF579ED11E}": "RECCTRLGUID",
    "{D046F2B0-5130-41B1-ABD7-38C12B32FAC3}": "GUID TRENDINFOGUID",
    "{CBEBA8E6-1CDA-4509-B6C2-6AC2EA7DB8F8}": "HWINFOGUID",
    "{E11C4CBA-0753-4655-A1E9-2B2309D1545B}": "VIDEOSYNCGUID",
    "{B9344241-7AC1-42B5-BE9B-B7AFA16CBFA5}": "SLEEPSCOREINFOGUID",
    "{15B41C32-0294-440E-ADFF-DD8B61C8B5AE}": "FOURIERSETTINGSGUID",
    "{024FA81F-6A83-43C8-8C82-241A5501F0A1}": "SPECTRUMGUID",
    "{8032E68A-EA3E-42E8-893E-6E93C59ED515}": "SIGNALINFOGUID",
    "{30950D98-C39C-4352-AF3E-CB17D5B93DED}": "SENSORINFOGUID",
    "{F5D39CD3-A340-4172-A1A3-78B2CDBCCB9F}": "DERIVEDSIGNALINFOGUID",
    "{969FBB89-EE8E-4501-AD40-FB5A448BC4F9}": "ARTIFACTINFOGUID",
    "{02948284-17EC-4538-A7FA-8E18BD65E167}": "STUDYINFOGUID",
    "{D0B3FD0B-49D9-4BF0-8929-296DE5A55910}": "PATIENTINFOGUID",
    "{7842FEF5-A686-459D-8196-769FC0AD99B3}": "DOCUMENTINFOGUID",
    "{BCDAEE87-2496-4DF4-B07C-8B4E31E3C495}": "USERSINFOGUID",
    "{B799F680-72A4-11D3-93D3-00500400C148}": "EVENTGUID",
    "{AF2B3281-7FCE-11D2-B2DE-00104B6FC652}": "SHORTSAMPLESGUID",
    "{89A091B3-972E-4DA2-9266-261B186302A9}": "DELAYLINESAMPLESGUID",
    "{291E2381-B3B4-44D1-BB77-8CF5C24420D7}": "GENERALSAMPLESGUID",
    "{5F11C628-FCCC-4FDD-B429-5EC94CB3AFEB}": "FILTERSAMPLESGUID",
    "{728087F8-73E1-44D1-8882-C770976478A2}": "DATEXDATAGUID",
    "{35F356D9-0F1C-4DFE-8286-D3DB3346FD75}": "TESTINFOGUID",
}
#: Names of the kinds of events, and the kind of an event's packet.
EVENT_NAMES = {
    "{A5A95612-A7F8-11CF-831A-0800091B5BDA}": "Annotation",
    "{A5A95646-A7F8-11CF-831A-0800091B5BDA}": "Seizure",
    "{08784382-C765-11D3-90CE-00104B6F4F70}": "Format change",
    "{6FF394DA-D1B8-46DA-B78F-866C67CF02AF}": "Photic",
    "{481DFC97-013C-4BC5-A203-871B0375A519}": "Posthyperventilation",
    "{725798BF-CD1C-4909-B793-6C7864C27AB7}": "Review progress",
    "{96315D79-5C24-4A65-B334-E31A95088D55}": "Exam start",
    "{A5A95608-A7F8-11CF-831A-0800091B5BDA}": "Hyperventilation",
    "{A5A95617-A7F8-11CF-831A-0800091B5BDA}": "Impedance",
}
EVENT_PACKET = "{B799F680-72A4-11D3-93D3-00500400C148}"
#: Fields of a patient by number from 1; 7 and 8 are dates, 23 and 24 numbers.
PATIENT = (
    "patientID", "firstName", "middleName", "lastName", "altID", "mothersMaidenName", "DOB", "DOD", "street", "sexID", "phone", "notes", "dominance", "siteID",
    "suffix", "prefix", "degree", "apartment", "city", "state", "country", "language", "height", "weight", "race", "religion", "maritalStatus",
)


def wide(b: bytes) -> str:
    return b.decode("utf-16-le", "replace").split("\x00")[0].strip()


def guid(b: bytes) -> str:
    g = (b[3::-1] + b[5:3:-1] + b[7:5:-1] + b[8:16]).hex().upper()
    return f"{{{g[:8]}-{g[8:12]}-{g[12:16]}-{g[16:20]}-{g[20:]}}}"


#: Fixed value: bytes of an event's packet before its text.
EVENT_BYTES = 272
#: Samples in a partition.
PIECE = 1 << 22


def field(key: int) -> str:
    return PATIENT[key - 1] if 1 <= key <= len(PATIENT) else f"field{key}"


def ole_us(days: float) -> int:
    return int((days * 86400 - 2209161600) * 1e6)


class Layout:
    """Tags, index and packets of one file."""

    def __init__(self, path: str):
        self.path = path
        (chain,) = struct.unpack("<I", read_at(path, 24, 4))
        (n_tags,) = struct.unpack("<I", read_at(path, TAGS_AT, 4))
        raw = read_at(path, TAGS_AT + 4, 84 * n_tags)
        self.tags = [(wide(raw[84 * i : 84 * i + 80]), struct.unpack_from("<I", raw, 84 * i + 80)[0]) for i in range(n_tags)]
        (entries,) = struct.unpack("<I", read_at(path, QI_AT, 4))
        self.sections: dict[int, list[tuple[int, int]]] = {}
        seen = 0
        while seen < entries and chain:
            (n,) = struct.unpack("<Q", read_at(path, chain, 8))
            rows = np.frombuffer(read_at(path, chain + 8, 24 * n), "<u8").reshape(-1, 3)
            for section, at, sizes in rows.tolist():
                self.sections.setdefault(section, []).append((at, round(sizes / 2**32)))
            seen += n
            (chain,) = struct.unpack("<Q", read_at(path, chain + 8 + 24 * n, 8))
            if not n:
                break

    def parts(self, tag: str) -> list[tuple[int, int]]:
        return self.sections.get(dict(self.tags).get(tag, -1), [])

    def section(self, tag: str) -> bytes:
        """A section's bytes, its parts one after the other."""
        return b"".join(read_at(self.path, at, size) for at, size in self.parts(tag))

    def named(self, name: str) -> bytes:
        """The section of a kind by its name."""
        return self.section(next(k for k, v in SECTION_NAMES.items() if v == name))

    def events(self) -> Iterator[dict]:
        """Event packets one after the other, each as long as it says; what has no event's kind ends the list."""
        for at, size in self.parts("Events")[:1]:
            end = at + size
            while at + EVENT_BYTES <= end:
                raw = read_at(self.path, at, EVENT_BYTES)
                length = struct.unpack_from("<Q", raw, 16)[0]
                if guid(raw[:16]) != EVENT_PACKET:
                    return
                days, rest, duration = struct.unpack_from("<ddd", raw, 32)
                kind, n_text = guid(raw[136:152]), struct.unpack_from("<Q", raw, 128)[0]
                yield {"t_us": ole_us(days) + round(rest * 1e6), "duration_us": round(duration * 1e6), "user": wide(raw[104:128]), "guid": kind, "type": EVENT_NAMES.get(kind, "UNKNOWN"), "label": wide(raw[168:232]), "text_length": n_text}
                if length < EVENT_BYTES:
                    return
                at += length

    def patient(self) -> dict[str, str]:
        """Fields by name: texts, numbers, and dates as year-month-day (to the nearest day)."""
        raw, out = self.named("PATIENTINFOGUID"), {}
        if not raw:
            return out
        n_values, n_texts = struct.unpack_from("<QQ", raw, 24)
        at = 40
        for _ in range(n_values):
            (key,), at = struct.unpack_from("<Q", raw, at), at + 8
            value = "0"
            if key in (7, 8, 23, 24):
                (number,), at = struct.unpack_from("<d", raw, at), at + 8
                value = str(np.datetime64(0, "D") + round((ole_us(number) + 43_200_000_000) // 86_400_000_000)) if key in (7, 8) else str(number)
            out[field(key)] = value
        heads = [struct.unpack_from("<QQ", raw, at + 16 * k) for k in range(n_texts)]
        at += 16 * n_texts
        for key, n in heads:
            out[field(key)] = wide(raw[at : at + 2 * (n + 1)])
            at += 2 * (n + 1)
        return out

    def montage(self) -> list[dict]:
        """Derivations of the montage with their two signals, and the colours of the display if it has as many traces."""
        raw, shown = self.named("DERIVATIONGUID"), self.named("DISPLAYGUID")
        if not raw:
            return []
        (n,) = struct.unpack_from("<I", raw, 744)
        rows = [{"montage": wide(raw[40:104]), "position": k, "derivation": wide(p[:128]), "signal_1": wide(p[128:192]), "signal_2": wide(p[192:256]), "color": None} for k in range(n) for p in (raw[752 + 520 * k : 752 + 520 * (k + 1)],)]
        if len(shown) >= 748 and struct.unpack_from("<I", shown, 744)[0] == n:
            for k, r in enumerate(rows):
                (r["color"],) = struct.unpack_from("<I", shown, 752 + 168 * k + 32)
        return rows

    def packets(self) -> list[tuple[str, bytes]]:
        """Dynamic packets: kind and data, which may span the parts of their section."""
        out = []
        for at, size in self.parts("InfoChangeStream")[:1]:
            raw = read_at(self.path, at, size)
            for k in range(size // PACKET):
                p = raw[PACKET * k : PACKET * (k + 1)]
                kind = guid(p[:16])
                first, length = struct.unpack_from("<QQ", p, 32)
                data, inside = b"", 0
                for part_at, part_size in self.parts(kind):
                    lo, hi = max(first, inside), min(first + length, inside + part_size)
                    if lo < hi:
                        data += read_at(self.path, part_at + lo - inside, hi - lo)
                    inside += part_size
                out.append((kind, data))
        return out

    def series(self) -> list[dict]:
        """Label, reference, rate and resolution of each channel, from the first time-series packet."""
        data = next((d for k, d in self.packets() if k == TS_PACKET), b"")
        if not data:
            return []
        (n,) = struct.unpack_from("<I", data, 752)
        out = []
        for i in range(n):
            p = data[760 + SIGNALS * i : 760 + SIGNALS * (i + 1)]
            low, high, rate, resolution = struct.unpack_from("<4d", p, 256)
            out.append({"label": wide(p[:64]), "reference": wide(p[192:200]), "rate": rate, "resolution": resolution})
        return out

    def segments(self) -> list[tuple[int, float]]:
        """Start in microseconds and duration in seconds."""
        return [(ole_us(struct.unpack_from("<d", raw, SEGMENT * k)[0]), struct.unpack_from("<d", raw, SEGMENT * k + 16)[0]) for at, size in self.parts("SegmentStream")[:1] for raw in (read_at(self.path, at, size),) for k in range(size // SEGMENT)]

    def channels(self) -> list[list[tuple[int, int]]]:
        """Sections of samples of each channel: tags that are numbers."""
        return [self.sections.get(section, []) for tag, section in self.tags if tag.isdigit()]


class Nicolet(Format):
    """A partition per segment, channel and stretch of a section of bounded size. A channel's samples run through its sections; segments cut them by their durations."""

    NAME = "nicolet"
    APART = True
    ENDS = (".e",)

    @staticmethod
    def plan(path, options):
        out = []
        for f in (x for x in list_files(path) if x.endswith(".e")):
            layout = Layout(f)
            for parts, s in zip(layout.channels(), layout.series()):
                elapsed = 0.0
                for start, duration in layout.segments():
                    first = int(int(elapsed) * s["rate"])
                    n = int(duration * s["rate"])
                    cuts, inside = [], 0
                    for at, size in parts:
                        lo, hi = max(first, inside), min(first + n, inside + size // 2)
                        if lo < hi:
                            cuts.append((at + 2 * (lo - inside), hi - lo))
                        inside += size // 2
                    elapsed += duration
                    done = 0
                    for at, size in cuts:
                        out += [Piece(f, s | {"at": at + 2 * a, "size": b - a, "first": done + a, "start": start, "n": n, "duration": duration}) for a, b in split(size, PIECE)]
                        done += size
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        step = i["duration"] * 1e6 / max(i["n"] - 1, 1)
        for a, b in split(i["size"], BATCH):
            x = np.frombuffer(read_at(piece.path, i["at"] + 2 * a, 2 * (b - a)), "<i2").astype(float) * i["resolution"]
            yield sample_batch(i["label"], options.get("unit", "uV"), i["rate"], i["start"] + np.arange(i["first"] + a, i["first"] + b) * step, x)


class NicoletSegments(Format):
    NAME = "nicolet_segments"
    APART = True
    ENDS = (".e",)
    KIND = "events"

    @staticmethod
    def plan(path, options):
        return [Piece(f) for f in list_files(path) if f.endswith(".e")]

    @staticmethod
    def decode(piece, options):
        s = Layout(piece.path).segments()
        yield event_batch(piece.path, ["segment"] * len(s), [t for t, _ in s], [str(k) for k in range(len(s))], [{"duration_s": str(d)} for _, d in s])


class NicoletTable(Format):
    """A row for each part of a file; columns by NAME."""

    APART = True
    ENDS = (".e",)
    COLUMNS: dict[str, pa.DataType] = {}

    def schema(self):
        return from_arrow_schema(pa.schema(self.COLUMNS))

    @staticmethod
    def plan(path, options):
        return [Piece(f) for f in list_files(path) if f.endswith(".e")]

    @classmethod
    def batches(cls, path: str, rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
        rows = ({"source": path} | r for r in rows)
        while part := list(islice(rows, 4096)):
            yield pa.RecordBatch.from_pylist(part, schema=pa.schema(cls.COLUMNS))


class NicoletEvents(NicoletTable):
    """Event markers: annotations, seizures, impedance checks and so on, named by their kind."""

    NAME = "nicolet_events"
    COLUMNS = {"source": pa.string(), "type": pa.string(), "guid": pa.string(), "t_us": pa.int64(), "duration_us": pa.int64(), "user": pa.string(), "label": pa.string(), "text_length": pa.int64()}

    @staticmethod
    def decode(piece, options):
        yield from NicoletEvents.batches(piece.path, Layout(piece.path).events())


class NicoletPatient(NicoletTable):
    """A file's patient, a row for each field."""

    NAME = "nicolet_patient"
    COLUMNS = {"source": pa.string(), "field": pa.string(), "value": pa.string()}

    @staticmethod
    def decode(piece, options):
        yield from NicoletPatient.batches(piece.path, ({"field": k, "value": v} for k, v in Layout(piece.path).patient().items()))


class NicoletMontage(NicoletTable):
    NAME = "nicolet_montage"
    COLUMNS = {"source": pa.string(), "montage": pa.string(), "position": pa.int32(), "derivation": pa.string(), "signal_1": pa.string(), "signal_2": pa.string(), "color": pa.int64()}

    @staticmethod
    def decode(piece, options):
        yield from NicoletMontage.batches(piece.path, Layout(piece.path).montage())


class NicoletSections(NicoletTable):
    """A file's sections: tag, name (UNKNOWN where it has none), number of parts and bytes."""

    NAME = "nicolet_sections"
    COLUMNS = {"source": pa.string(), "tag": pa.string(), "name": pa.string(), "parts": pa.int32(), "bytes": pa.int64()}

    @staticmethod
    def decode(piece, options):
        layout = Layout(piece.path)
        rows = ((tag, layout.sections.get(section, [])) for tag, section in layout.tags)
        name = lambda tag: SECTION_NAMES.get(tag, "UNKNOWN") if tag.startswith("{") else tag
        yield from NicoletSections.batches(piece.path, ({"tag": tag, "name": name(tag), "parts": len(p), "bytes": sum(n for _, n in p)} for tag, p in rows))


ALL = (Nicolet, NicoletSegments, NicoletEvents, NicoletPatient, NicoletMontage, NicoletSections)
