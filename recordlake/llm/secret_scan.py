"""Secrets by fixed shapes, and by zstandard novelty against their surroundings."""

from __future__ import annotations

import hashlib
import re
from math import log2

import zstandard
from pyspark.sql import DataFrame

from recordlake.llm.frames import annotate

KINDS = ("assign", "access", "hex", "novel")

# leftmost non-overlapping matches; a run shorter than its kind asks for cannot
# pass further right either, so the least length may stand in the pattern
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
CONTEXT = re.compile(
    r"passw|pwd|secret|token|api.?key|credential|private|bearer|access.?key|signature"
    r"|(?:(?<![a-z])o?|(?-i:(?<=[a-z])(?=A)))auth(?:ori[sz]ation|enticat(?:ion|e))?(?:(?![a-z])|(?-i:(?=[A-Z])))",
    re.IGNORECASE | re.ASCII,
)

# fixed values: words that identifiers in code are commonly made of
IDENTIFIERS = (
    "abstract access account action active address admin alias alpha app append application "
    "archive args array assert async attribute auth author backup base batch begin binary block "
    "body bool boolean buffer build bytes cache call callback cancel case catch char check child "
    "class clear client clone close cluster code column command commit common compare component "
    "config connect connection const constructor container content context control copy count "
    "create current cursor data database date debug default define delete delta description "
    "device dict directory disable document domain double element email enable encoding end "
    "entity enum environment error event example exception execute export extend extra factory "
    "false field file filter final find first float folder format function generate get global "
    "group handle handler hash header height hidden host http https id image import index info "
    "init input insert instance integer interface internal item iterator job join json key label "
    "language last layout length level limit line link list load local location lock log login "
    "logger long main manager map mask master match max member memory message metadata method "
    "min mode model module name namespace native network new next node none null number object "
    "offset open option order output override package page panel parameter parent parse password "
    "path pattern payload pending permission phone platform plugin point policy pool port position "
    "prefix previous primary print priority private process processor product profile program "
    "progress project property protected protocol provider proxy public publish query queue random "
    "range raw read reader ready record redirect reference refresh region register registry "
    "release remote remove render replace reply report repository request require reset resource "
    "response result retry return role root route router row rule run sample scan schedule schema "
    "scope script search second secret section security select send sequence serial server service "
    "session set setting shared signature single size socket sort source space span split stack "
    "stage standard start state static status step stop storage store stream string style subject "
    "submit success suffix summary switch sync system table tag target task template temp test "
    "text thread threshold time timeout timestamp title token tool total trace track transaction "
    "transfer transform trigger true type undefined union unique unit unknown unlock update upload "
    "url user username util valid validate value variable vector verify version view visible "
    "volume wait warning watch web weight width window word work worker wrapper write writer xml "
    "year yes zero zip zone "
    # words of prose that are written together with hyphens, and endings of long words
    "about above after again against all almost also always among and another any around assured "
    "available aware away back based because become been before being below best better between "
    "big both bottom bound brand bring build built business but by call can care career center "
    "century change cold come company complete computer computing consuming cost could country "
    "cross current customer cut daily day decade decision deep defined dependent design detail "
    "determined developed different dimensional direct distance down driven duty each early earth "
    "easy economic effective eight else end energy engineer English environment equal established "
    "even ever every example experience face fact fair family far fast few field five forward four "
    "free friendly from front full function functional further future general generated given good "
    "government grade great green ground grown growing had half hand hard have head health heart "
    "heavy held help here high highly him his home hour house how hundred important independent "
    "industrial industry initial inside international interest into just keep kind known labor "
    "land large last late law lead learning least left less letter level life light like line "
    "little live living local long look low made make making man management many market matter "
    "maintained mean measure media medium mid middle million mind minute money month more most "
    "mother much multi must national nature near need never next night nine non nor not nothing "
    "now number occasion off office often old once one only open operated or order organized other our "
    "out over own paid part party past pay people per performance person place plan play political "
    "power present pressure price private produced profit proof public purpose put quality quick "
    "quite rate rather reaching real reason recent red related relationship religious research "
    "right rich risk river road same saving say scale school science see seen self semi sense "
    "separate series serious seven several short should show side simple since six slow small so "
    "social society some soon sound speaking special speed spread stated still strength strong "
    "structure student study such sudden super support sure take team technology ten term than "
    "that the their them then there these they thing think third this those though thought "
    "thousand three through thus to together top toward trade traditional training tree turn twenty "
    "two under understanding university until up use used using usual very vice war was water way "
    "week well went were what when where which while white who whole why wide will winning wise "
    "with within without woman wonder world worth would written wrong young your "
    "ability able ably acknowledgement action ade ally ament ance ancy ant arian aries arity ary "
    "ately ation ational ations ative ature bility cation certificate cesses charact cial cially "
    "cious city cognit commun compat conduct configuration connectivity consequence construct "
    "contra counter credential cular cury decrypt dential dependency deployment descriptor dict "
    "digital diction director discipl dispro duction electro encourage encrypted ency enhance "
    "ential entially equival erence eristic ering erous essor establish etically exception expected "
    "expiration expiry fication formation fulness graph graphic guidance hydro hyper iality "
    "ibility ication ience ification iness inform ing ingly instruct inter interactive interrupt "
    "ionally isation istic istically ities ition ity ival ivity ization ization keyboard lessness "
    "lication linary logical logically luminous manufact mater maximum ment mentally mentation "
    "ments micro minimum mission multiple nationalization ness nesses neuro nificant ograph ological ology "
    "operation ordinary organization osity ously partic payment philosoph photo physi poly port "
    "portion portionate possibilities pre predict professional pseudo psycho public publication "
    "punct qualification quantit recogn recommend repres respons responsibilities rious "
    "satisf scientific semantic sion sional spectro stitut struct subsequent substant sufficient "
    "symmetr synchron tele telecommunications temper theoretical therm tial tically tion tional tively "
    "trans transport tribution tually ture ular ulation unbeliev uncharacter vers verification "
    "vertis virtual vision vulner org com net io src main java javax apache google android github "
    "python lib bin usr etc var opt www html css json yaml"
)

LEVEL = 16
# the least share of a candidate's length that its compressed bytes take. Measured on
# random keys of six alphabets against names of the Python library: see README
LEAST = 0.81
# from here on compression can tell a key's alphabet, and the share falls towards its bits
LONG, OF_ALPHABET = 128, 0.9
# words as names are put together from: WordsOfAName, words_of_a_name, WORDS_OF_A_NAME
WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])")
JOINS = re.compile(r"[ _-]+")
# letters as frequent as in prose: what stands around a candidate in a short text is
# filled up with it, so that a share means the same in short and long texts
FILLER = (
    "itnmee rtnleraeesseoedse dtauulellneaed tistdtlid fatlluantdyedecarfrs ihlhnio ag oelirr"
    " iphocetrsavithsewekdl iifnlrl he eohgweepgiulf hoyn_wnehnactrea otponn reahsdo_t s dogs"
    "nf_noteatomoeh laooetsrncditf rcmwpeh f dnnsnthuseaeasttiletedtrtncee acntuoncnhtt hhhhi"
    "ettbipoh ftrearntfdekriu eg ornan ard riuac k a o sp oarrnpee ohoafcnh ynneatohaiahcc eh"
    "mn ue mtn yvah_as uie ynhsbeytatetlh mtc lhmntddtee ymtrbts a aeoairokliods tepn-hml rs "
    "rtrtrre s ace tathcytdeifrrdh t_deoaoe trhdek-esicrcrafohrr hro"
)


# what a text must hold, its A-Z lower-cased, for ASSIGN or CONTEXT to match at all
ASSIGN_PARTS = tuple(b"password passwd secret token apikey api_key".split())
CONTEXT_PARTS = tuple(
    b"passw pwd secret token api credential private auth bearer access signature".split()
)
HEX_ONLY = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
HEX_RUN = b"x" * 32


def holds(raw: bytes, parts: tuple[bytes, ...]) -> bool:
    return any(part in raw for part in parts)


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Base spans as (start, kind number, end), and their number by kind."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = []
    if holds(raw.lower(), ASSIGN_PARTS):
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    counts = [len(spans)]
    may_be_hex = HEX_RUN in raw.translate(HEX_ONLY)
    for number, pattern in ((1, ACCESS), (2, HEX if may_be_hex else None)):
        found = [(m.start(), number, m.end()) for m in pattern.finditer(text)] if pattern else []
        counts.append(len(found))
        spans += found
    spans.sort()
    return spans, counts


def least_of(found: str) -> float:
    """The least share for a candidate, by its length and the number of its characters."""
    floor = min(LEAST, OF_ALPHABET * log2(len(set(found))) / 8)
    return floor + (LEAST - floor) * min(1.0, LONG / len(found))


def apart(text: str) -> str:
    """The text with the words of names apart and in lower case, as the dictionary has them.

    Short runs of one case, which keys are made of, stay as they are.
    """
    return JOINS.sub(" ", WORD.sub(lambda m: f" {m[0].lower()} ", text))


class Novelty:
    """Marginal compressed bytes of a candidate, given what stands around it."""

    def __init__(self, identifiers: str, window: int, least: float | None):
        words = zstandard.ZstdCompressionDict(
            apart(identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        # parts of words match from three letters on; the fast levels miss many of them
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            min_match=3,
            source_size=2 * window + 64,
            dict_size=len(identifiers),
            write_content_size=False,
            write_checksum=False,
        )
        words.precompute_compress(compression_params=how)
        self.compressor = zstandard.ZstdCompressor(dict_data=words, compression_params=how)
        self.window, self.least = window, least

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode("utf-8", "surrogatepass")))

    def share(self, text: str, start: int, end: int) -> float:
        """Compressed bytes the candidate adds, over its own length, words of names taken apart.

        Equal copies are taken out of what stands around it, also those that
        the window's edge would cut, so that a secret does not hide its like.
        """
        found, reach = text[start:end], self.window + end - start
        before = text[max(0, start - reach) : start].replace(found, " ")
        after = text[end : end + reach].replace(found, " ")
        around = apart(before[max(0, len(before) - self.window) :] + after[: self.window])
        around = (FILLER + around)[-2 * self.window :] + " "
        return (self.size(around + apart(found)) - self.size(around)) / (end - start)

    def spans(self, text: str, near: int) -> list[tuple[int, int, int]]:
        """Candidates in a sensitive context that do not compress."""
        if not holds(text.encode("utf-8", "surrogatepass").lower(), CONTEXT_PARTS):
            return []
        found = []
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            # digits alone are a number
            if m[0].isdigit():
                continue
            if not CONTEXT.search(text, max(0, start - near), start):
                continue
            least = least_of(m[0]) if self.least is None else self.least
            if self.share(text, start, end) >= least:
                found.append((start, 3, end))
        return found


FIELDS = {
    "n_assign": "bigint",
    "n_access": "bigint",
    "n_hex": "bigint",
    "n_novel": "bigint",
    "base_sha256": "string",
    "spans": "string",
}


def listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(
    df: DataFrame,
    text: str = "text",
    *,
    window: int = 256,
    near: int = 48,
    least: float | None = None,
    identifiers: str = IDENTIFIERS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Find secrets in every whole text.

    Base kinds by shape: ``assign``, ``access``, ``hex``. To these the method
    adds ``novel``: runs of 16 or more token characters that are not digits
    alone, with a sensitive word within ``near`` characters before them, that
    zstandard, primed with ``identifiers`` and given ``window`` characters on
    either side, cannot shorten below ``least`` bytes a character (if None,
    what ``least_of`` gives for their length and alphabet). Before that the words of
    names, such as ``WordsOfAName``, are taken apart and put in lower case. A
    novel span inside a base span is not repeated; overlapping ones stay.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and
    then kind. A null or empty text has none; every row is scanned by itself,
    so ties, repeated rows and empty tables need no special case. ``keep``
    names the columns to carry (all if None); columns named like a result are
    replaced by it.
    """

    def make():
        novelty = Novelty(identifiers, window, least)

        def row(value):
            value = value or ""
            base, counts = spans_of(value)
            novel = [
                span
                for span in novelty.spans(value, near)
                if not any(start <= span[0] and span[2] <= end for start, _, end in base)
            ]
            return (
                *counts,
                len(novel),
                hashlib.sha256(listed(base).encode()).hexdigest(),
                listed(sorted(base + novel)),
            )

        return row

    return annotate(df, make, FIELDS, [text], keep)


def redact(
    df: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[SECRET]"
) -> DataFrame:
    """``text`` with every span of ``spans`` replaced by ``mark``.

    Overlapping and touching spans become one mark. A null text stays null,
    and a null or empty list of spans leaves the text as it is.
    """

    def make():
        def row(value, listing):
            if value is None or not listing:
                return (value,)
            places = sorted(
                (int(start), int(end))
                for _, start, end in (item.split(":") for item in listing.split(","))
            )
            parts, at, last = [], 0, -1
            for start, end in places:
                if start > last:
                    parts += [value[at:start], mark]
                at = last = max(last, end)
            return ("".join([*parts, value[at:]]),)

        return row

    order = df.columns
    return annotate(df, make, {text: "string"}, [text, spans]).select(
        *[f"`{c}`" for c in order]
    )
