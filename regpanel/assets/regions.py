"""Lookup table of the federal subjects: code, name, short name, ISO code.

Fixed values -- region resolution must return exactly these names and codes
(86 rows, in their published order; the order breaks fuzzy-match ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: code;name;short_name;iso_code ----
REGIONS_CSV = """\
01;Республика Адыгея;Адыгея;RU-AD
02;Республика Башкортостан;Башкортостан;RU-BA
03;Республика Бурятия;Бурятия;RU-BU
04;Республика Алтай;Алтай;RU-AL
05;Республика Дагестан;Дагестан;RU-DA
06;Республика Ингушетия;Ингушетия;RU-IN
07;Кабардино-Балкарская республика;Кабардино-Балкарская;RU-KB
08;Республика Калмыкия;Калмыкия;RU-KL
09;Карачаево-Черкесская республика;Карачаево-Черкесская;RU-KC
10;Республика Карелия;Карелия;RU-KR
11;Республика Коми;Коми;RU-KO
12;Республика Марий Эл;Марий Эл;RU-ME
13;Республика Мордовия;Мордовия;RU-MO
14;Республика Саха (Якутия);Саха /Якутия/;RU-SA
15;Республика Северная Осетия - Алания;Северная Осетия - Алания;RU-SE
16;Республика Татарстан;Татарстан;RU-TA
17;Республика Тыва;Тыва;RU-TY
18;Удмуртская республика;Удмуртская;RU-UD
19;Республика Хакасия;Хакасия;RU-KK
20;Чеченская республика;Чеченская;RU-CE
21;Чувашская республика - Чувашия;Чувашская Республика;RU-CU
22;Алтайский край;Алтайский;RU-ALT
23;Краснодарский край;Краснодарский;RU-KDA
24;Красноярский край;Красноярский;RU-KYA
25;Приморский край;Приморский;RU-PRI
26;Ставропольский край;Ставропольский;RU-STA
27;Хабаровский край;Хабаровский;RU-KHA
28;Амурская область;Амурская;RU-AMU
29;Архангельская область;Архангельская;RU-ARK
30;Астраханская область;Астраханская;RU-AST
31;Белгородская область;Белгородская;RU-BEL
32;Брянская область;Брянская;RU-BRY
33;Владимирская область;Владимирская;RU-VLA
34;Волгоградская область;Волгоградская;RU-VGG
35;Вологодская область;Вологодская;RU-VLG
36;Воронежская область;Воронежская;RU-VOR
37;Ивановская область;Ивановская;RU-IVA
38;Иркутская область;Иркутская;RU-IRK
39;Калининградская область;Калининградская;RU-KGD
40;Калужская область;Калужская;RU-KLU
41;Камчатский край;Камчатский;RU-KAM
42;Кемеровская область - Кузбасс;Кемеровская область - Кузбасс;RU-KEM
43;Кировская область;Кировская;RU-KIR
44;Костромская область;Костромская;RU-KOS
45;Курганская область;Курганская;RU-KGN
46;Курская область;Курская;RU-KRS
47;Ленинградская область;Ленинградская;RU-LEN
48;Липецкая область;Липецкая;RU-LIP
49;Магаданская область;Магаданская;RU-MAG
50;Московская область;Московская;RU-MOS
51;Мурманская область;Мурманская;RU-MUR
52;Нижегородская область;Нижегородская;RU-NIZ
53;Новгородская область;Новгородская;RU-NGR
54;Новосибирская область;Новосибирская;RU-NVS
55;Омская область;Омская;RU-OMS
56;Оренбургская область;Оренбургская;RU-ORE
57;Орловская область;Орловская;RU-ORL
58;Пензенская область;Пензенская;RU-PNZ
59;Пермский край;Пермский;RU-PER
60;Псковская область;Псковская;RU-PSK
61;Ростовская область;Ростовская;RU-ROS
62;Рязанская область;Рязанская;RU-RYA
63;Самарская область;Самарская;RU-SAM
64;Саратовская область;Саратовская;RU-SAR
65;Сахалинская область;Сахалинская;RU-SAK
66;Свердловская область;Свердловская;RU-SVE
67;Смоленская область;Смоленская;RU-SMO
68;Тамбовская область;Тамбовская;RU-TAM
69;Тверская область;Тверская;RU-TVE
70;Томская область;Томская;RU-TOM
71;Тульская область;Тульская;RU-TUL
72;Тюменская область;Тюменская;RU-TYU
73;Ульяновская область;Ульяновская;RU-ULY
74;Челябинская область;Челябинская;RU-CHE
75;Забайкальский край;Забайкальский;RU-ZAB
76;Ярославская область;Ярославская;RU-YAR
77;Москва;Москва;RU-MOW
78;Санкт-Петербург;Санкт-Петербург;RU-SPE
79;Еврейская автономная область;Еврейская;RU-YEV
83;Ненецкий автономный округ;Ненецкий;RU-NEN
86;Ханты-Мансийский автономный округ - Югра;Ханты-Мансийский Автономный округ - Югра;RU-KHM
87;Чукотский автономный округ;Чукотский;RU-CHU
89;Ямало-Ненецкий автономный округ;Ямало-Ненецкий;RU-YAN
91;Республика Крым;Крым;UA-43
92;Севастополь;Севастополь;UA-40
99;Иные территории, включая город и космодром Байконур;Байконур;KZ-BAY
"""


def region_rows() -> list[tuple[int, str, str, str, str]]:
    """``(_row, code, name, short_name, iso_code)`` in table order."""
    out = []
    for i, line in enumerate(REGIONS_CSV.strip().splitlines()):
        code, name, short, iso = line.split(";")
        out.append((i, code, name, short, iso))
    return out


def regions_table(spark: SparkSession) -> DataFrame:
    """The table as a small DataFrame (a local relation: always broadcastable)."""
    return spark.createDataFrame(
        region_rows(), "_row int, code string, name string, short_name string, iso_code string")
