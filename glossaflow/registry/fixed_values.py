"""The published language lists this engine resolves codes against.

One language per line, ``code  name``, in the order of the published lists.
"""

# Flores-200 language codes and names.
FLORES = """
ace_Arab  Acehnese (Arabic script)
ace_Latn  Acehnese (Latin script)
acm_Arab  Mesopotamian Arabic
acq_Arab  Ta’izzi-Adeni Arabic
aeb_Arab  Tunisian Arabic
afr_Latn  Afrikaans
ajp_Arab  South Levantine Arabic
aka_Latn  Akan
amh_Ethi  Amharic
apc_Arab  North Levantine Arabic
arb_Arab  Modern Standard Arabic
arb_Latn  Modern Standard Arabic (Romanized)
ars_Arab  Najdi Arabic
ary_Arab  Moroccan Arabic
arz_Arab  Egyptian Arabic
asm_Beng  Assamese
ast_Latn  Asturian
awa_Deva  Awadhi
ayr_Latn  Central Aymara
azb_Arab  South Azerbaijani
azj_Latn  North Azerbaijani
bak_Cyrl  Bashkir
bam_Latn  Bambara
ban_Latn  Balinese
bel_Cyrl  Belarusian
bem_Latn  Bemba
ben_Beng  Bengali
bho_Deva  Bhojpuri
bjn_Arab  Banjar (Arabic script)
bjn_Latn  Banjar (Latin script)
bod_Tibt  Standard Tibetan
bos_Latn  Bosnian
bug_Latn  Buginese
bul_Cyrl  Bulgarian
cat_Latn  Catalan
ceb_Latn  Cebuano
ces_Latn  Czech
cjk_Latn  Chokwe
ckb_Arab  Central Kurdish
crh_Latn  Crimean Tatar
cym_Latn  Welsh
dan_Latn  Danish
deu_Latn  German
dik_Latn  Southwestern Dinka
dyu_Latn  Dyula
dzo_Tibt  Dzongkha
ell_Grek  Greek
eng_Latn  English
epo_Latn  Esperanto
est_Latn  Estonian
eus_Latn  Basque
ewe_Latn  Ewe
fao_Latn  Faroese
fij_Latn  Fijian
fin_Latn  Finnish
fon_Latn  Fon
fra_Latn  French
fur_Latn  Friulian
fuv_Latn  Nigerian Fulfulde
gla_Latn  Scottish Gaelic
gle_Latn  Irish
glg_Latn  Galician
grn_Latn  Guarani
guj_Gujr  Gujarati
hat_Latn  Haitian Creole
hau_Latn  Hausa
heb_Hebr  Hebrew
hin_Deva  Hindi
hne_Deva  Chhattisgarhi
hrv_Latn  Croatian
hun_Latn  Hungarian
hye_Armn  Armenian
ibo_Latn  Igbo
ilo_Latn  Ilocano
ind_Latn  Indonesian
isl_Latn  Icelandic
ita_Latn  Italian
jav_Latn  Javanese
jpn_Jpan  Japanese
kab_Latn  Kabyle
kac_Latn  Jingpho
kam_Latn  Kamba
kan_Knda  Kannada
kas_Arab  Kashmiri (Arabic script)
kas_Deva  Kashmiri (Devanagari script)
kat_Geor  Georgian
knc_Arab  Central Kanuri (Arabic script)
knc_Latn  Central Kanuri (Latin script)
kaz_Cyrl  Kazakh
kbp_Latn  Kabiyè
kea_Latn  Kabuverdianu
khm_Khmr  Khmer
kik_Latn  Kikuyu
kin_Latn  Kinyarwanda
kir_Cyrl  Kyrgyz
kmb_Latn  Kimbundu
kmr_Latn  Northern Kurdish
kon_Latn  Kikongo
kor_Hang  Korean
lao_Laoo  Lao
lij_Latn  Ligurian
lim_Latn  Limburgish
lin_Latn  Lingala
lit_Latn  Lithuanian
lmo_Latn  Lombard
ltg_Latn  Latgalian
ltz_Latn  Luxembourgish
lua_Latn  Luba-Kasai
lug_Latn  Ganda
luo_Latn  Luo
lus_Latn  Mizo
lvs_Latn  Standard Latvian
mag_Deva  Magahi
mai_Deva  Maithili
mal_Mlym  Malayalam
mar_Deva  Marathi
min_Arab  Minangkabau (Arabic script)
min_Latn  Minangkabau (Latin script)
mkd_Cyrl  Macedonian
plt_Latn  Plateau Malagasy
mlt_Latn  Maltese
mni_Beng  Meitei (Bengali script)
khk_Cyrl  Halh Mongolian
mos_Latn  Mossi
mri_Latn  Maori
mya_Mymr  Burmese
nld_Latn  Dutch
nno_Latn  Norwegian Nynorsk
nob_Latn  Norwegian Bokmål
npi_Deva  Nepali
nso_Latn  Northern Sotho
nus_Latn  Nuer
nya_Latn  Nyanja
oci_Latn  Occitan
gaz_Latn  West Central Oromo
ory_Orya  Odia
pag_Latn  Pangasinan
pan_Guru  Eastern Panjabi
pap_Latn  Papiamento
pes_Arab  Western Persian
pol_Latn  Polish
por_Latn  Portuguese
prs_Arab  Dari
pbt_Arab  Southern Pashto
quy_Latn  Ayacucho Quechua
ron_Latn  Romanian
run_Latn  Rundi
rus_Cyrl  Russian
sag_Latn  Sango
san_Deva  Sanskrit
sat_Olck  Santali
scn_Latn  Sicilian
shn_Mymr  Shan
sin_Sinh  Sinhala
slk_Latn  Slovak
slv_Latn  Slovenian
smo_Latn  Samoan
sna_Latn  Shona
snd_Arab  Sindhi
som_Latn  Somali
sot_Latn  Southern Sotho
spa_Latn  Spanish
als_Latn  Tosk Albanian
srd_Latn  Sardinian
srp_Cyrl  Serbian
ssw_Latn  Swati
sun_Latn  Sundanese
swe_Latn  Swedish
swh_Latn  Swahili
szl_Latn  Silesian
tam_Taml  Tamil
tat_Cyrl  Tatar
tel_Telu  Telugu
tgk_Cyrl  Tajik
tgl_Latn  Tagalog
tha_Thai  Thai
tir_Ethi  Tigrinya
taq_Latn  Tamasheq (Latin script)
taq_Tfng  Tamasheq (Tifinagh script)
tpi_Latn  Tok Pisin
tsn_Latn  Tswana
tso_Latn  Tsonga
tuk_Latn  Turkmen
tum_Latn  Tumbuka
tur_Latn  Turkish
twi_Latn  Twi
tzm_Tfng  Central Atlas Tamazight
uig_Arab  Uyghur
ukr_Cyrl  Ukrainian
umb_Latn  Umbundu
urd_Arab  Urdu
uzn_Latn  Northern Uzbek
vec_Latn  Venetian
vie_Latn  Vietnamese
war_Latn  Waray
wol_Latn  Wolof
xho_Latn  Xhosa
ydd_Hebr  Eastern Yiddish
yor_Latn  Yoruba
yue_Hant  Yue Chinese
zho_Hans  Chinese (Simplified)
zho_Hant  Chinese (Traditional)
zsm_Latn  Standard Malay
zul_Latn  Zulu
"""

# Language codes and names of the cloud translation service. Three names carry two codes.
CLOUD = """
af  Afrikaans
ak  Akan
sq  Albanian
am  Amharic
ar  Arabic
hy  Armenian
as  Assamese
ay  Aymara
az  Azerbaijani
bm  Bambara
eu  Basque
be  Belarusian
bn  Bengali
bho  Bhojpuri
bs  Bosnian
bg  Bulgarian
ca  Catalan
ceb  Cebuano
ny  Chichewa
zh  Chinese (Simplified)
zh-CN  Chinese (Simplified)
zh-TW  Chinese (Traditional)
co  Corsican
hr  Croatian
cs  Czech
da  Danish
dv  Divehi
doi  Dogri
nl  Dutch
en  English
eo  Esperanto
et  Estonian
ee  Ewe
tl  Filipino
fi  Finnish
fr  French
fy  Frisian
gl  Galician
lg  Ganda
ka  Georgian
de  German
gom  Goan Konkani
el  Greek
gn  Guarani
gu  Gujarati
ht  Haitian Creole
ha  Hausa
haw  Hawaiian
iw  Hebrew
he  Hebrew
hi  Hindi
hmn  Hmong
hu  Hungarian
is  Icelandic
ig  Igbo
ilo  Iloko
id  Indonesian
ga  Irish
it  Italian
ja  Japanese
jw  Javanese
jv  Javanese
kn  Kannada
kk  Kazakh
km  Khmer
rw  Kinyarwanda
ko  Korean
kri  Krio
ku  Kurdish (Kurmanji)
ckb  Kurdish (Sorani)
ky  Kyrgyz
lo  Lao
la  Latin
lv  Latvian
ln  Lingala
lt  Lithuanian
lb  Luxembourgish
mk  Macedonian
mai  Maithili
mg  Malagasy
ms  Malay
ml  Malayalam
mt  Maltese
mni-Mtei  Manipuri (Meitei Mayek)
mi  Maori
mr  Marathi
lus  Mizo
mn  Mongolian
my  Myanmar (Burmese)
ne  Nepali
nso  Northern Sotho
no  Norwegian
or  Odia (Oriya)
om  Oromo
ps  Pashto
fa  Persian
pl  Polish
pt  Portuguese
pa  Punjabi
qu  Quechua
ro  Romanian
ru  Russian
sm  Samoan
sa  Sanskrit
gd  Scots Gaelic
sr  Serbian
st  Sesotho
sn  Shona
sd  Sindhi
si  Sinhala
sk  Slovak
sl  Slovenian
so  Somali
es  Spanish
su  Sundanese
sw  Swahili
sv  Swedish
tg  Tajik
ta  Tamil
tt  Tatar
te  Telugu
th  Thai
ti  Tigrinya
ts  Tsonga
tr  Turkish
tk  Turkmen
uk  Ukrainian
ur  Urdu
ug  Uyghur
uz  Uzbek
vi  Vietnamese
cy  Welsh
xh  Xhosa
yi  Yiddish
yo  Yoruba
zu  Zulu
"""

# The languages of multilingual T5 (arXiv 2010.11934, table 6).
MT5 = """
af  Afrikaans
sq  Albanian
am  Amharic
ar  Arabic
hy  Armenian
az  Azerbaijani
eu  Basque
be  Belarusian
bn  Bengali
bg  Bulgarian
my  Burmese
ca  Catalan
ceb  Cebuano
ny  Chichewa
zh  Chinese
co  Corsican
cs  Czech
da  Danish
nl  Dutch
en  English
eo  Esperanto
et  Estonian
fil  Filipino
fi  Finnish
fr  French
gl  Galician
ka  Georgian
de  German
el  Greek
gu  Gujarati
ht  Haitian Creole
ha  Hausa
haw  Hawaiian
iw  Hebrew
hi  Hindi
hmn  Hmong
hu  Hungarian
is  Icelandic
ig  Igbo
id  Indonesian
ga  Irish
it  Italian
ja  Japanese
jv  Javanese
kn  Kannada
kk  Kazakh
km  Khmer
ko  Korean
ku  Kurdish
ky  Kyrgyz
lo  Lao
la  Latin
lv  Latvian
lt  Lithuanian
lb  Luxembourgish
mk  Macedonian
mg  Malagasy
ms  Malay
ml  Malayalam
mt  Maltese
mi  Maori
mr  Marathi
mn  Mongolian
ne  Nepali
no  Norwegian
ps  Pashto
fa  Persian
pl  Polish
pt  Portuguese
pa  Punjabi
ro  Romanian
ru  Russian
sm  Samoan
gd  Scottish Gaelic
sr  Serbian
sn  Shona
sd  Sindhi
si  Sinhala
sk  Slovak
sl  Slovenian
so  Somali
st  Sotho
es  Spanish
su  Sundanese
sw  Swahili
sv  Swedish
tg  Tajik
ta  Tamil
te  Telugu
th  Thai
tr  Turkish
uk  Ukrainian
ur  Urdu
uz  Uzbek
vi  Vietnamese
cy  Welsh
fy  West Frisian
xh  Xhosa
yi  Yiddish
yo  Yoruba
zu  Zulu
"""
