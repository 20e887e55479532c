"""Personal information inside free text (problem 1).

Patterns propose spans, checksum validators confirm them where a number has a check character (Luhn,
mod-97, mod-11-2: a wrong one is out unless a label names the number), and words before a span move its
score; spans at or above the threshold are kept, the surest type first where they overlap. Full-width forms are folded
one to one, so spans are positions in the text as it stands.

Types: email, phone, id_number, address, name. Defined cases: null stays null and has no span; text
of any length is read whole; values already masked (stars, bracketed words, underscores) are no span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

FOLD = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}
KEEP = 0.5

# Words that mark what a number or name is.
EMAIL = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9][\w.+%-]*\s?(?:@|[\[({]\s?at\s?[\])}]|\s+at\s+(?=\w+(?:\.\w+)*\s+dot\s))\s?"
    r"[A-Za-z0-9][A-Za-z0-9-]*(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[A-Za-z0-9-]+)*(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[A-Za-z]{2,}(?![A-Za-z0-9_@])",
    re.I | re.A,
)
ID_EN = re.compile(
    r"\b(?:ssn|social security(?: no\.?| number| nr\.?)?|nhs(?: no\.?| number)?|mrn|medical record(?: no\.?| number)?|hospital (?:no\.?|number)|"
    r"patient (?:id|no\.?|number)|admission(?: no\.?| number| id)|national (?:id|identity)(?: no\.?| number| card)?|identity (?:card|no\.?|number)|"
    r"(?:insurance|health insurance|member|membership|policy|medicare|medicaid)(?: id| no\.?| number| card)+|passport(?: no\.?| number)?)"
    r"\s*(?:is|was|[:#=])?\s*((?:[A-Z]{1,4}[- ]?)?\d(?:[- .]?\d){3,20}[A-Z]?)\b",
    re.I | re.A,
)
ID_ZH = re.compile(
    r"(?:身份证|护照|医保|社保|病案|住院|病历|门诊|就诊|参保|登记证|通行证|保险|保单)(?:卡|证)?(?:号码|编号|号)?\s*(?:是|为|[:#])?\s*((?:[A-Za-z]{1,4}[- ]?)?\d(?:[- ]?[0-9Xx]){4,22})"
)
CITIZEN = re.compile(r"(?<![\dA-Za-z.])\d{6}[ -]?(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])[ -]?\d{3}[\dXx](?![\dA-Za-z])")
SSN = re.compile(r"(?<![\d.-])\d{3}([- ])\d{2}\1\d{4}(?![\d-])")
ACCOUNT = re.compile(r"(?<![\w.-])(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|\d{4}(?:[ -]?\d{4}){2,3}\d{0,3})(?![\w-])")
NEVER_ISSUED = re.compile(r"(?:000|666)..*|\d{3}.00.*|.*0000")
FOR_ID = re.compile(r"(?:证|卡|账|\b(?:card|account|iban|id|identity|identification)\b)[^.;。；]{0,12}$", re.I)
PHONE = [
    (0.8, re.compile(r"(?<![0-9A-Za-z_+])(?:\+|(?<![.-])00[ -])\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,8}){1,4}(?:\s*(?:ext|x)\.?\s*\d{1,6})?(?![\dA-Za-z])", re.I)),
    (0.7, re.compile(r"(?<![0-9A-Za-z_.+-])(?:\(\d{3}\) ?|\d{3}([ .-]))\d{3}[ .-]\d{4}(?:\s*(?:ext|x)\.?\s*\d{1,6})?(?![\d-])", re.I)),
    (0.6, re.compile(r"(?<![0-9A-Za-z_.+-])0\d{2,4}[ -]?\d{3}[ -]?\d{3,4}(?![\d-])")),
    (0.6, re.compile(r"(?<![0-9A-Za-z_.+-])(?:\(0\d{2,3}\)|0\d{2,3}-) ?\d{7,8}(?![\d-])")),
    (0.6, re.compile(r"(?<![\dA-Za-z.+-])1[3-9]\d(?:[ -]?\d{4}){2}(?![\d-])")),
    (0.6, re.compile(r"(?<![零〇一二三四五六七八九十百千万])[一幺][三四五六七八九][零〇幺一二两三四五六七八九]{9}(?![零〇一二三四五六七八九十百千万])")),
    (0.3, re.compile(r"(?<![0-9A-Za-z_.+/-])\d{3}-\d{4}(?![\d/-])")),
]
FOR_PHONE = re.compile(r"(?:call|ring|rung|phone|phoned|tel|telephone|mobile|contact|reach|reached|fax|whatsapp|dial|text)\b[^.;]{0,24}$|(?:电话|手机|联系|打|拨|致电|热线)[^。；]{0,6}$", re.I)
WHEN_TO_RING = re.compile(r"\)?,? ?(?:mornings?|afternoons?|evenings?|nights?|weekdays?|weekends?|daytime|any ?time|office hours|after (?:\d|six|five)|before (?:\d|noon))\b", re.I)
NO_PERSON = re.compile(r"(?:批号|序列号|检查编号|检查号|编号|影像号|床|病区|条码|单号|\b(?:lot|batch|serial|accession|uid|device|study|series|order|invoice|bed|ward|room|film|index|item)(?: no\.?| number| id| lot)?)\s*[:#]?\s*[\w./-]{0,6}$", re.I)
SUFFIX = r"(?:street|st|avenue|ave|road|rd|lane|ln|court|ct|close|terrace|rise|drive|way|place|crescent|gardens|square|boulevard|blvd|parkway|mews|grove)"
ADDRESS_EN = re.compile(
    r"(?:\b(?:flat|apt|apartment|unit|suite)\.? ?\w{1,4}, ?)?(?:\bhouse (?:no\.?|number) ?\d{1,5}[a-z]?,? (?:on|in|at) |(?<![\w.,/-])\d{1,5}[a-z]?,? )"
    r"(?:[a-z][a-z'-]+ ){1,3}" + SUFFIX + r"\b\.?(?:, ?(?:flat|apt|apartment|unit|suite)\.? ?\w{1,4})?",
    re.I,
)
AT = re.compile(r"(?:\b(?:at|to|from|in|on|reads?|is|near|address|live|visit|home)\b|[:(,])\s*$", re.I)
ADDRESS_ZH = re.compile(
    r"(?:[一-鿿]{2,5}(?:省|市|自治区))?(?:[一-鿿]{2,4}[市区县旗])?(?:[一-鿿]{2,4}[镇乡])?[一-鿿]{1,5}(?:路|街|大道|道|巷|弄|胡同|里|村|坊)"
    r"(?:[零一二三四五六七八九十百\d]+弄)?[零一二三四五六七八九十百\d]{1,6}(?:-\d{1,4})?(?:号院?|弄|幢|栋)(?:[\d]+(?:号楼|栋|幢|单元|号))?(?:\d+单元)?(?:\d+(?:室|楼|层))?"
)
TITLE = r"(?:dr|mr|mrs|ms|miss|mx|prof|professor|doctor|nurse|sister)"
WORD = r"[A-Za-z][A-Za-z'’-]+"
FULL = rf"(?:{TITLE}\.? )?(?:{WORD}, {WORD}|{WORD} (?:[A-Za-z]\. )?{WORD}|{WORD} [A-Za-z]\.|[A-Za-z]\. {WORD})"
SHORT = rf"{TITLE}\.? {WORD}"
WHO = rf"({FULL}|{SHORT})"
NAME_EN = [
    (0.9, re.compile(rf"\b(?:my name is|name:|patient:|patient name:|signed:?|yours,|dictated by|this is) {WHO}(?= writing| speaking| here|[.,;)]|\s*$)", re.I)),
    (0.7, re.compile(rf"\b(?:referred by|reported by|reviewed by|repeated by|seen by|performed by|read by|copy to|copied to|(?:result |results )?discussed with|seen (?:together )?with|booked for|on behalf of|asked by|spoke (?:to|with)|told) {WHO}(?= at | this | who|, who|[.,;)]|\s*$)", re.I)),
    (0.7, re.compile(rf"\bi am {WHO}(?=,|\.)", re.I)),
    (0.7, re.compile(rf"(?:(?<=[.!?:;)] )|(?<=[.!?])|^){WHO}(?= (?:was told|called|rang|phoned|asked|requested|wrote|was informed|is the referring))", re.I)),
]
TITLED = re.compile(rf"\b(?:Dr|Mr|Mrs|Ms|Miss|Prof|Professor|Nurse|Sister|DR|MR|MRS|MS|MISS|PROF|NURSE|SISTER)\.? (?:[A-Z][a-z'’-]+|[A-Z]{{2,}})(?:(?:, | )(?:[A-Z][a-z'’-]+|[A-Z]{{2,}}|[A-Z]\.))?")
# Words that no person's name of these patterns has.
COMMON = frozenset(
    "the a an and or of for with at to from in on this that not none all any medicine surgery clinic department team ward unit service services staff doctor nurse "
    "radiology cardiology neurology urology gynaecology paediatrics dermatology orthopaedics ophthalmology gastroenterology endocrinology emergency "
    "general internal respiratory imaging pain swelling aged patient years year old taking taken today yesterday telephone family imaging x-ray film ct mri scan my your his her "
    "currently now still very also already about pregnant diabetic worried afraid sure allergic he she it they we you feeling having using trying thanks hello good dear".split()
)
# Family names.
SURNAMES = "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜戚谢邹喻柏窦章云苏潘葛范彭郎鲁韦马苗凤方俞任袁柳鲍史唐费廉岑薛雷贺倪汤滕殷罗毕郝邬安常乐于傅卞齐康伍余顾孟黄穆萧尹姚邵汪祁毛狄贝计伏成戴宋庞熊纪舒屈项祝董梁杜阮蓝闵席季麻贾路娄江童颜郭梅林刁钟徐邱骆高夏蔡田樊胡凌霍虞万柯管卢莫房裘缪解应宗丁宣邓洪包左石崔吉龚程邢裴陆荣翁甄曲封储靳段焦巴牧隗谷车侯宓蓬郗班仰秋仲伊宫宁仇栾甘厉祖武符刘景詹束龙叶司黎薄印白蒲邰鄂索赖卓蔺屠蒙池乔阴胥闻党翟谭贡姬申冉郦桑桂牛边扈燕冀尚温庄晏柴瞿阎慕连茹习艾鱼容向古易慎廖庾居衡步耿满弘匡寇广东欧利蔚越夔隆师巩聂晁勾敖融冷辛阚那简饶曾沙鞠关蒯相查游竺权漆巫鄢肖涂"
MAN = rf"[{SURNAMES}][一-鿿]{{1,2}}"
NAME_ZH = [
    (0.9, re.compile(rf"(?:我叫|姓名[:]\s?|孩子叫|名叫|叫做|联系人[:]?\s?|患者[:]?\s?|病人[:]?\s?|本人|落款[:]?\s?|签名[:]?\s?)({MAN})(?=[,。;!?.\s)）]|$|[，；！？、])")),
    (0.8, re.compile(rf"(?:我是|这里是)({MAN})(?=[,，。.!！\s]|$)")),
    (0.8, re.compile(rf"[帮替]({MAN})(?=[问咨看挂])")),
    (0.8, re.compile(rf"(?:^|[。！？!?\s，,（(）)])({MAN})(?=的?(?:家属|家人|妈妈|爸爸|女儿|儿子)(?:留言|咨询|来))")),
    (0.8, re.compile(rf"(?:——|--|—)\s?({MAN})(?=\s*$|[。\n（(]|医生|大夫|您好|你好)", re.M)),
    (0.7, re.compile(rf"(?:(?<=[是次找由请经让给和跟问见看到约])|(?<=[，。！？,!?\s：:（(])|^)([{SURNAMES}][一-鿿]{{0,2}}?(?:医生|护士|大夫|主任|教授|先生|女士|医师|老师))")),
]
NOT_NAME_ZH = re.compile(r"^(?:麻醉|康复|安宁|管床|贝|何时|任何|向您|高血|高龄|白血|甘油|车祸|关节|乐|相关|和|东|成年|应|容易|温|连|查|解|广|计|权)")

PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
ORDER = ("email", "id_number", "phone", "address", "name")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return bool(digits) and total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def citizen(digits: str) -> bool:
    """Check character of an 18-character resident identity number (ISO 7064 mod 11-2)."""
    total = sum(int(d) * pow(2, 17 - i, 11) for i, d in enumerate(digits[:17]))
    return "10X98765432"[total % 11] == digits[17].upper()


def _before(text: str, at: int, width: int = 32) -> str:
    return text[max(0, at - width) : at]


def _context(text: str, at: int) -> float:
    """What the words before a number say for or against its being a person's."""
    head = _before(text, at)
    return 0.3 * bool(FOR_ID.search(head)) - 0.5 * bool(NO_PERSON.search(head))


def _person(words: str) -> bool:
    parts = [w for w in re.findall(r"[A-Za-z'’-]+", words) if not re.fullmatch(TITLE, w, re.I)]
    return bool(parts) and not any(w.lower() in COMMON for w in parts)


def find_spans(raw: str) -> list[tuple[int, int, str]]:
    """``(start, end, type)`` of the personal data in a text, in order and without overlap."""
    text = raw.translate(FOLD)
    found: dict[str, list[tuple[float, int, int]]] = {t: [] for t in ORDER}
    digits = any(c.isdigit() for c in text)
    if "@" in text or re.search(r"\bat\b", text, re.I):
        found["email"] += [(1.0, *m.span()) for m in EMAIL.finditer(text)]
    if digits:
        for pattern in (ID_EN, ID_ZH):
            for m in pattern.finditer(text):
                if sum(c.isdigit() for c in m[1]) >= 5:
                    found["id_number"].append((0.9, *m.span(1)))
        # a number with a check character is one if that is right; else only words before it can tell
        for m in CITIZEN.finditer(text):
            score = 0.7 if citizen(re.sub(r"[ -]", "", m[0])) else 0.2
            found["id_number"].append((score + _context(text, m.start()), *m.span()))
        for m in SSN.finditer(text):
            score = 0.2 if NEVER_ISSUED.fullmatch(m[0]) else 0.6
            found["id_number"].append((score + _context(text, m.start()), *m.span()))
        for m in ACCOUNT.finditer(text):
            plain = re.sub(r"[ -]", "", m[0])
            sure = luhn(plain) if plain.isdigit() else mod97(plain)
            found["id_number"].append((0.5 * sure + _context(text, m.start()), *m.span()))
        for base, pattern in PHONE:
            for m in pattern.finditer(text):
                head = _before(text, m.start())
                near = FOR_PHONE.search(head) or WHEN_TO_RING.match(text, m.end())
                score = base + 0.3 * bool(near) - 0.6 * bool(NO_PERSON.search(head))
                found["phone"].append((score, *m.span()))
        for m in ADDRESS_EN.finditer(text):
            words = re.findall(r"[A-Za-z'-]+", m[0])
            names = [w for w in words if not re.fullmatch(rf"{SUFFIX}|flat|apt|apartment|unit|suite|house|no|number|on|in|at|\w", w, re.I)]
            written = bool(names) and all(w[0].isupper() for w in names) and not text.isupper()
            led = bool(AT.search(_before(text, m.start())) or re.match(r"(?i)flat|apt|apartment|unit|suite|house", m[0]))
            plain = any(w.lower() in COMMON or w.lower() in ("mg", "cm", "mm", "nights", "days", "weeks", "months", "percent", "units") for w in names)
            end = m.end() - (m[0].endswith(".") and not re.search(r"(?i)\b(?:st|ave|rd|ln|ct|blvd)\.$", m[0]))
            found["address"].append((0.4 * written + 0.5 * led - 0.9 * plain + 0.1 * bool(names), m.start(), end))
    elif re.search(r"[一幺][三四五六七八九][零〇幺一二两三四五六七八九]{9}", text):
        found["phone"] += [(0.6, *m.span()) for m in PHONE[5][1].finditer(text)]
    if "号" in text or "弄" in text or "栋" in text or "幢" in text:
        for m in ADDRESS_ZH.finditer(text):
            lead = max(m[0].rfind(c, 0, 8) for c in "在到从离往向址")  # the word before the place
            found["address"].append((0.8, m.start() + lead + 1, m.end()))
    for base, pattern in NAME_EN:
        for m in pattern.finditer(text):
            who = m[1]
            plain = re.sub(rf"^{TITLE}\.? ", "", who, flags=re.I)
            written = all(w[0].isupper() for w in re.findall(WORD, plain))
            kinds = {w.isupper() * 2 + w[0].isupper() for w in re.findall(WORD, plain)}
            score = base - 1.0 * (not _person(who) or len(kinds) > 1) - 0.1 * (not written)
            found["name"].append((score, *m.span(1)))
    for m in TITLED.finditer(text):
        found["name"].append((0.7 - 1.0 * (not _person(m[0])), *m.span()))
    if not text.isascii():
        for base, pattern in NAME_ZH:
            for m in pattern.finditer(text):
                found["name"].append((base - 0.6 * bool(NOT_NAME_ZH.match(m[1])), *m.span(1)))
    taken: list[tuple[int, int, str]] = []
    for kind in ORDER:
        for score, a, b in sorted(found[kind], key=lambda x: (-x[0], x[1])):
            if score >= KEEP and not any(a < y and x < b for x, y, _ in taken):
                taken.append((a, b, kind))
    return sorted(taken)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], PLACEHOLDER[kind]]
        at = b
    return "".join([*out, text[at:]])


def personal_data(df: DataFrame) -> DataFrame:
    """``df(grp, id, text)`` -> ``grp, id, text`` with placeholders, and ``types``: the sorted types found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, types = [], []
            for t in batch.column("text").to_pylist():
                spans = find_spans(t) if t else []
                out.append(redact(t, spans) if t else t)
                types.append(sorted({k for _, _, k in spans}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("id"), pa.array(out, pa.string()), pa.array(types, pa.list_(pa.string()))],
                names=["grp", "id", "text", "types"],
            )

    return df.select("grp", "id", "text").mapInArrow(run, "grp string, id long, text string, types array<string>")
