"""The four functions that Spark lacks, as Arrow-batched UDFs."""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def ascii_fold(names: pd.Series) -> pd.Series:
    """Letters without their accents; what has no ASCII form goes."""
    return names.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def alike(a: str, b: str) -> float:
    """Similarity by insertions and deletions, 0 to 100."""
    total = len(a) + len(b)
    return 200.0 * common_length(a, b) / total if total else 100.0


def token_set_score(a: str | None, b: str | None) -> float:
    """Best similarity among what two token sets share and what each has besides; 100 if one holds the other."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (left and right):
        return 100.0
    p, q = f"{both} {left}".strip(), f"{both} {right}".strip()
    scores = [alike(p, q)]
    if both:
        scores += [alike(both, p), alike(both, q)]
    return max(scores)


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


#: Ordinary sentences and frequent words by language; the detector's statistics are counted on them.
SAMPLES = {
    "ca": "les coses que es fan amb cura duren més i no cal tornar a començar quan tothom hi posa una mica de temps perquè els qui hi són saben també què vol dir aquesta feina i com es pot fer millor amb les eines que tenim a casa nostra el la els de del i en un una per a amb no és que són aquest aquesta també més molt ha han com si seva seu entre fins però",
    "de": "wir haben in diesem jahr einen neuen weg gefunden um die arbeit besser zu machen und die ergebnisse zeigen dass es auch für andere möglich ist wenn man sich zeit nimmt und nicht nur auf das schaut was schon immer so gemacht wurde der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde",
    "en": "we have found a new way to do this work and the results show that it is also possible for others when they take the time and do not only look at what has always been done before in this field and which of these methods would give the best answer the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our",
    "es": "hemos encontrado este año una nueva manera de hacer el trabajo y los resultados muestran que también es posible para otros cuando se toman el tiempo y no miran solo lo que siempre se ha hecho antes en este campo de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso",
    "fr": "nous avons trouvé cette année une nouvelle manière de faire ce travail et les résultats montrent que cela est aussi possible pour les autres quand ils prennent le temps et ne regardent pas seulement ce qui a toujours été fait avant dans ce domaine de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son ses aux d'une cette ces mais comme ou si leur y dont elle deux tout nous sa même fait être après aussi",
    "it": "abbiamo trovato quest'anno un nuovo modo di fare il lavoro e i risultati mostrano che è possibile anche per gli altri quando si prendono il tempo e non guardano solo quello che è sempre stato fatto prima in questo campo di e il la che in un a per è una sono con non si da come le dei nel alla più anche ma gli della del al delle ha se questo i lo su nella stato hanno tra o essere",
    "nl": "wij hebben dit jaar een nieuwe manier gevonden om het werk te doen en de resultaten laten zien dat het ook voor anderen mogelijk is als zij de tijd nemen en niet alleen kijken naar wat altijd al zo is gedaan in dit veld de van een het en in is dat op te zijn met voor niet aan er om ook als dan maar bij uit nog naar door over ze hij of was wordt tot kan je werd worden zich meer",
    "pt": "encontramos este ano uma nova maneira de fazer o trabalho e os resultados mostram que também é possível para outros quando tomam o seu tempo e não olham apenas para o que sempre foi feito antes neste campo de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso",
}
#: Least share of the evidence, beyond which a text is of no known language.
DETECTED = 0.5


@functools.lru_cache(1)
def _trigrams() -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages, and of each three characters of a word (its bounds included) the log chances by language, smoothed."""
    names = sorted(SAMPLES)
    counts: dict[str, np.ndarray] = {}
    for at, name in enumerate(names):
        for word in SAMPLES[name].split():
            for g in _grams(word):
                counts.setdefault(g, np.zeros(len(names)))[at] += 1
    sums = sum(counts.values()) + 0.5 * len(counts)
    return names, {g: np.log((v + 0.5) / sums) for g, v in counts.items()}


def _grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


_letters = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


def guess_language(text: str | None) -> str | None:
    """Likeliest language of a text by its words' trigrams; null if it has no known one, or no language stands out."""
    names, chances = _trigrams()
    total, known = np.zeros(len(names)), 0
    for word in _letters.findall((text or "").lower()):
        for g in _grams(word):
            if (c := chances.get(g)) is not None:
                total, known = total + c, known + 1
    if not known:
        return None
    share = np.exp(total - total.max())
    best = int(share.argmax())
    return names[best] if share[best] / share.sum() >= DETECTED else None


@F.pandas_udf(T.StringType())
def detect_language(texts: pd.Series) -> pd.Series:
    return texts.map(guess_language)


@functools.lru_cache(100_000)
def _pieces(word: str, size: int, grams: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of a word and its character grams."""
    padded = f" {word} "
    hashes = np.array([zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in (word, *(padded[i : i + grams] for i in range(len(padded) - grams + 1)))], dtype=np.int64)
    return hashes % size, np.where(hashes & 1 << 20, 1.0, -1.0)


def hashed_embedding(text: str, size: int, grams: int = 3) -> np.ndarray:
    """Unit vector of hashed words and character grams."""
    found = [_pieces(w, size, grams) for w in text.lower().split()]
    if not found:
        return np.zeros(size, dtype=np.float32)
    v = np.bincount(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), size)
    norm = np.linalg.norm(v)
    return (v / norm if norm else v).astype(np.float32)


def embedding(text: Column, size: int = 384) -> Column:
    """Unit vector (array<float>) of a text by the default encoder; null texts are empty."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: hashed_embedding(t or "", size))

    return encode(text)
