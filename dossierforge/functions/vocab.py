"""Fixed values. They have to equal those of the data that this engine replaces, so they are stated plainly."""

# Entity suffixes that a company name may end with
ENTITY_SUFFIX = r"(?iU)\s+(B\.?V\.?|N\.?V\.?|Holdings?)\s*$"

# Paths by tier, in order of preference
TIER_1 = (
    "/about /about-us /over-ons /over /colofon /who-we-are /wie-we-zijn /company /bedrijf /story /ons-verhaal /history /geschiedenis "
    "/manifesto /mission /missie /vision /visie /values /waarden /what-we-do /wat-we-doen /how-we-work /hoe-wij-werken /aanpak "
    "/onze-aanpak /werkwijze /process /proces /services /diensten /products /producten /solutions /oplossingen /platform /expertise "
    "/expertises /specialisaties /portfolio /our-work /ons-werk /sectors /sectoren /industries /branches /technology /technologie "
    "/research /onderzoek /culture /cultuur /impact /sustainability /duurzaamheid"
).split()
TIER_2 = (
    "/cases /case-studies /projects /projecten /team /leadership /founders /people /mensen /clients /klanten /customers /referenties "
    "/references /testimonials /partners /locations /locaties /vestigingen /kantoren /offices /careers /jobs /werken-bij /vacatures "
    "/pricing /prijzen /press /pers /media /faq /veelgestelde-vragen /contact /contact-us /privacy /disclaimer /algemene-voorwaarden"
).split()
TIER_3 = "/blog /nieuws /news /actueel /updates /insights /inzichten /articles /artikelen".split()
ADDRESS_POSITION = -1
MAX_URLS, MIN_PAGES, PREFIX_CAP = 12, 3, 2

# Extensions of links that aren't pages
EXCLUDED_EXTENSIONS = "pdf doc docx xls xlsx ppt pptx zip tar gz rar 7z jpg jpeg png gif webp svg ico mp3 mp4 wav mov avi webm csv json xml".split()

# Slugs of pages that tend to hold an address
ADDRESS_STEMS = "contact colofon disclaimer privacy legal voorwaarden condities terms imprint impressum".split()
ADDRESS_TOKENS = "about over ons".split()
ADDRESS_SLUGS = "contact contact-us over-ons about about-us colofon privacy disclaimer algemene-voorwaarden".split()

# Words near a postcode
BOOST_HINTS = ["bezoekadres", "hoofdkantoor", "vestiging", "vestigingsadres", "kantooradres", "hq", "headquarters", "head office", "main office", "registered office", "visiting address", "office address"]
DEMOTE_HINTS = ["postadres", "correspondentieadres", "factuuradres", "mailing address", "postal address", "po box", "p.o. box"]
CONTEXT_BEFORE, CONTEXT_AFTER, HINT_WINDOW, SNIPPET = 80, 40, 60, 200

# Dutch function words
DUTCH = "de het een en van voor met zijn wordt worden onze wij ons niet ook aan bij naar over door maar heeft hebben dat die deze u je om te".split()
LANGUAGE_WORDS, DUTCH_SHARE = 400, 0.06

AXES = ["substance", "ecology", "power", "embeddedness", "posture"]
EVIDENCE = ["well_evidenced", "partial", "no_signal"]
PROMINENCE = ["core", "supporting", "incidental"]
CONFIDENCE = ["high", "low"]
FAILURES = ["upstream_failed", "empty", "llm_error"]
FACT_SUCCESS = ["regex_single", "regex_disambiguated", "llm_fallback"]
SCHEMA_VERSION = 2
THIN_CHARS, SUBSTANTIAL_CHARS = 100, 2000
DOSSIER_CHARS, FALLBACK_CHARS = 24_000, 2_000
MAX_SITEMAPS, MAX_LOCS = 3, 500

# ISCO-08 minor groups
ISCO = (
    "011 021 031 111 112 121 122 131 132 133 134 141 142 143 211 212 213 214 215 216 221 222 223 224 225 226 231 232 233 234 235 241 242 243 "
    "251 252 261 262 263 264 265 311 312 313 314 315 321 322 323 324 325 331 332 333 334 335 341 342 343 351 352 411 412 413 421 422 431 432 "
    "441 511 512 513 514 515 516 521 522 523 524 531 532 541 611 612 613 621 622 631 632 633 634 711 712 713 721 722 723 731 732 741 742 751 "
    "752 753 754 811 812 813 814 815 816 817 818 821 831 832 833 834 835 911 912 921 931 932 933 941 951 952 961 962"
).split()

# Elements whose edges are line breaks in extracted text
BLOCK_TAGS = "address article aside blockquote br div dd dl dt fieldset footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split()

# Public suffixes, in the form of the public list: a name, *.name (any label before it) or !name (none after all); other hosts are taken whole
SUFFIX_RULES = (
    "com net org nl be de fr es it eu uk io co info biz dev app ai nu me tv at ch dk se no fi pl pt ie lu us ca au nz jp br in cn tech cloud online shop amsterdam frl "
    "co.uk org.uk ac.uk gov.uk com.au net.au org.au co.nz co.jp co.za com.br com.cn com.tr co.in co.kr "
    "*.ck !www.ck *.bd *.np *.mm *.er *.fk *.kw *.kawasaki.jp !city.kawasaki.jp *.kobe.jp !city.kobe.jp *.nagoya.jp !city.nagoya.jp"
).split()
