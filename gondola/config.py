"""Feed configuration and the fixed values the results depend on.

Everything in the FIXED VALUES block must stay exactly as written: the
column names, placeholder strings and patterns decide which rows match,
which are dropped and what the reports contain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source pipeline's for identical results)
# ---------------------------------------------------------------------------

# Text written into a missing or empty nomenclature cell.
NOT_FILLED = "NON RENSEIGNE"

# Native product levels and customer segments a feed must carry.
PRODUCT_LEVELS = ["level_1", "level_2", "level_3", "level_4", "level_5", "level_6", "level_7"]
CUSTOMER_SEGMENTS = ["segment_1", "segment_2", "segment_3", "segment_4", "segment_5", "segment_6"]

# Standard nomenclature produced by the correspondence tables.
PRODUCT_STANDARDS = ["level_1_standard", "level_2_standard", "level_3_standard", "level_4_standard"]
CUSTOMER_STANDARDS = ["segment_1_standard", "segment_2_standard", "segment_3_standard"]

# Silver projection, in this order (columns a feed lacks are skipped).
SILVER_COLUMNS = (
    ["product_id", "product_code", "product_name", "brand_name"]
    + PRODUCT_LEVELS
    + CUSTOMER_SEGMENTS
    + PRODUCT_STANDARDS
    + CUSTOMER_STANDARDS
    + ["department", "year", "month", "turnover", "volume", "volume_unit"]
)

# Columns cast to text and stripped of surrounding whitespace in a feed.
STRIP_COLUMNS = (
    ["product_id", "product_code", "product_name", "brand_name", "year", "volume_unit"]
    + PRODUCT_LEVELS
    + CUSTOMER_SEGMENTS
)

# Product ids that mean "no product id".
INVALID_PRODUCT_IDS = ["", "0", "#", "Non Defini"]

# Per-item placeholder in level_4_standard; such rows never count as a class.
ITEM_PLACEHOLDERS = ["A L'EAN", "A l'EAN"]

# Separator of the classification path built from the native levels.
CLASSIFICATION_SEPARATOR = ">"

# Owner columns of the two correspondence tables.
PRODUCT_MAP_OWNER = "ENTREPRISE"
CUSTOMER_MAP_OWNER = "ENSEIGNE"

# Department cleaning: first match removed, then zero-filled to 2 characters.
DEPARTMENT_PREFIX_PATTERN = r"^0|FR/"
DEPARTMENT_WIDTH = 2

# Character repair in one feed's mapping levels (first "?" becomes "ї").
CHAR_REPAIR = {"metro": (r"\?", "ї")}

# Two-digit years widened in the period split of the sysco feed.
YEAR_WIDENING = {"23": "2023", "24": "2024"}

# Quantity-in-name patterns: all matches, case-insensitive, Unicode classes.
# Groups: 1 = number, 2 = unit, 3 = multiplier ("x12", "x12x4").
QUANTITY_PATTERN = r"(?iU)(\d+(?:\.|,)*\d*)\s*(g|kg|k|ml|cl|l|gr)\s*(x\s*\d+(?:(?:\s|\))*x\s*\d+)*)?"
QUANTITY_PATTERN_STRICT = r"(?iU)\b(\d+(?:\.|,)*\d*)\s*(g|kg|ml|cl|l|gr)\s*(x\s*\d+(?:\s*x\s*\d+)*)?\b"

# Misclassification compares these silver columns across retailers.
MISCLASS_COLUMNS = (
    ["product_name", "classification", "volume_unit"] + PRODUCT_STANDARDS + CUSTOMER_STANDARDS
)

# Amounts are summed as decimals with this many places, so totals do not depend
# on the order of summation; wide enough not to round amounts as delivered.
AMOUNT_SCALE = 6
# Market shares of a zero total are null.
SHARE_ON_ZERO = "null"


@dataclass(frozen=True)
class FeedSpec:
    """One distributor feed: how its columns map onto the canonical schema."""

    name: str
    rename: dict[str, str] = field(default_factory=dict)
    add_columns: dict[str, str] = field(default_factory=dict)
    turnover_type: str = "unknown"
    has_product_id: bool | None = None
    zip_department: bool | None = None

    @property
    def with_product_id(self) -> bool:
        if self.has_product_id is not None:
            return self.has_product_id
        return "product_id" in self.rename.values()

    @property
    def department_from_zip(self) -> bool:
        if self.zip_department is not None:
            return self.zip_department
        return "zip_code" in self.rename.values()


# Rename maps of the ten distributor feeds (source column -> canonical name).
FEEDS: dict[str, FeedSpec] = {
    "coup_de_pates": FeedSpec(
        "coup_de_pates",
        rename={
            "[EAN13]": "product_id",
            "[Code Produit]": "product_code",
            "[Libellé Produit]": "product_name",
            "[Marque Produit]": "brand_name",
            "[Famille Produit]": "level_1",
            "[Sous Famille Produit]": "level_2",
            "[Sous Famille 2 Produit]": "level_3",
            "[Nature Produit]": "level_4",
            "[Etat Produit]": "level_5",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "[Code Departement]": "department",
            "[Année]": "year",
            "[Mois Calendaire]": "month",
            "[CA N]": "turnover",
            "[Nb Colis N]": "quantity",
            "[Poids N]": "volume",
            "Unité Poids": "volume_unit",
            "[Activite Client 1]": "segment_1",
            "[Activite Client 2]": "segment_2",
            "[Type Client]": "segment_3",
        },
        turnover_type="unknown",
    ),
    "ds_restauration": FeedSpec(
        "ds_restauration",
        rename={
            "EAN UVC": "product_id",
            "Code Produit": "product_code",
            "Nom Produit": "product_name",
            "Marque": "brand_name",
            "Fournisseur": "supplier_name",
            "Frais/Surg": "level_1",
            "Grande famille MKT": "level_2",
            "Famille MKT": "level_3",
            "Sous-famille MKT": "level_4",
            "Sous-sous-famille MKT": "level_5",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Département Client": "department",
            "Année": "year",
            "Mois": "month",
            "CA Net (€)": "turnover",
            "Volume Vendu (kg)": "volume",
        },
        add_columns={"volume_unit": "KG"},
        turnover_type="net",
    ),
    "ducreux": FeedSpec(
        "ducreux",
        rename={
            "Article code": "product_code",
            "Article lib": "product_name",
            "Secteur code": "level_1",
            "Secteur lib": "level_2",
            "Catégorie lib": "level_3",
            "Sous Catégorie lib": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Département code": "department",
            "Année": "year",
            "Mois": "month",
            "CA": "turnover",
            "Poids net liv": "volume",
            "Unité Fact lib": "volume_unit",
            "Activité client lib": "segment_1",
        },
        turnover_type="unknown",
    ),
    "even": FeedSpec(
        "even",
        rename={
            "Code EAN 13 Article Fournisseur Sodis": "product_id",
            "Code Article Sodis": "product_code",
            "Désignation Article Sodis": "product_name",
            "Libellé Marque Article Sodis": "brand_name",
            "Nom du Fournisseur Art Mouvt": "supplier_name",
            "Libellé Famille Article Sodis": "level_1",
            "Libellé Sous-Fam 1 Article Sodis": "level_2",
            "Libellé Sous-Fam 2 Article Sodis": "level_3",
            "Libellé Sous-Fam 3 Article Sodis": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "N° Département  ( du CP )": "department",
            "Année de Livraison": "year",
            "Mois de Livraison": "month",
            "Montant HT Brut Facturé": "turnover",
            "Poids Saisi Livré": "volume",
            "Libellé Type Enseigne": "segment_1",
            "Libellé Centrale": "segment_2",
            "Libellé Plateforme": "segment_3",
        },
        add_columns={"volume_unit": "KG"},
        turnover_type="brut",
    ),
    "metro": FeedSpec(
        "metro",
        rename={
            "gtin": "product_id",
            "art_no": "product_code",
            "art_name": "product_name",
            "brand_name": "brand_name",
            "SA": "level_1",
            "GA": "level_2",
            "SGA": "level_3",
            "SSGA": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "departement": "department",
            "annee": "year",
            "mois": "month",
            "CA_HT": "turnover",
            "Poids_volume": "volume",
            "unite_volume": "volume_unit",
            "classification_client": "segment_1",
        },
        turnover_type="HT",
    ),
    "pomona": FeedSpec(
        "pomona",
        rename={
            "EAN/UPC": "product_id",
            "Article": "product_code",
            "Article LIBELLE": "product_name",
            "Mque comm.": "brand_name",
            "Mque indus": "supplier_name",
            "Hiér. produit niv. 1": "level_1",
            "Hiér. produit niv. 2": "level_2",
            "Hiér. produit niv. 3": "level_3",
            "Hiér. produit niv. 4": "level_4",
            "Hiér. produit niv. 5": "level_5",
            "Hiér. produit niv. 6": "level_6",
            "Gpe marchandise": "level_7",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Département client": "department",
            "annee": "year",
            "CA brut": "turnover",
            "Poids livré": "volume",
            "Segment 1": "segment_1",
            "Segment 2": "segment_2",
            "Segment 3": "segment_3",
            "Segment 4": "segment_4",
            "Catégorie": "segment_5",
            "Sous Catégorie": "segment_6",
        },
        add_columns={"volume_unit": "unknown"},
        turnover_type="brut",
    ),
    "pro_a_pro": FeedSpec(
        "pro_a_pro",
        rename={
            "Code Article International": "product_id",
            "Code Article Interne": "product_code",
            "Libelle Article": "product_name",
            "Libelle Marque - ": "brand_name",
            "Libelle Fournisseur - ": "supplier_name",
            "Secteur": "level_1",
            "Famille": "level_2",
            "Sous Famille": "level_3",
            "Sous Sous Famille": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Département d'activité client": "zip_code",
            "Année": "year",
            "Mois": "month",
            "CA facturé hors taxe": "turnover",
            "Volume facturé": "volume",
            "Secteur d'activité client": "segment_1",
            "Segment d'activité client": "segment_2",
            "Mode d'activité client": "segment_3",
        },
        add_columns={"volume_unit": "KG"},
        turnover_type="HT",
    ),
    "relais_dor": FeedSpec(
        "relais_dor",
        rename={
            "Code produit": "product_code",
            "Lib produit": "product_name",
            "Marque": "brand_name",
            "Hiérarchie Tout Produit niv 1": "level_1",
            "Hiérarchie Tout Produit niv 2": "level_2",
            "Hiérarchie Tout Produit niv 3": "level_3",
            "Hiérarchie Tout Produit niv 4": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "CP": "zip_code",
            "Année de ventes": "year",
            "Mois de ventes": "month",
            "CA": "turnover",
            "Poids": "volume",
            "Fam Cli": "segment_1",
            "SFam Cli": "segment_2",
            "SSFam Cli": "segment_3",
            "SSSFam Cli": "segment_4",
        },
        add_columns={"volume_unit": "unknown"},
        turnover_type="unknown",
    ),
    "sysco": FeedSpec(
        "sysco",
        rename={
            "Code EAN Unité de base (UB)": "product_id",
            "Code article": "product_code",
            "Libellé article": "product_name",
            "Température produit": "level_1",
            "Libellé hic produit Sysco N2": "level_2",
            "Libellé hic produit Sysco N3": "level_3",
            "Libellé hic produit Sysco N4": "level_4",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Departement": "department",
            "year": "year",
            "month": "month",
            "CA Brut": "turnover",
            "Quantité KG": "volume",
            "Code typologie CG": "segment_1",
            "Libellé famille client Sisense": "segment_2",
        },
        add_columns={"volume_unit": "KG"},
        turnover_type="brut",
    ),
    "transgourmet": FeedSpec(
        "transgourmet",
        rename={
            "Code EAN13": "product_id",
            "Code Article Centrale": "product_code",
            "Nom Court Article": "product_name",
            "Nom Marque": "brand_name",
            "Nom Fournisseur Réception": "supplier_name",
            "Gamme Tdb": "level_1",
            "Nom Famille": "level_2",
            "Nom Sous Famille": "level_3",
            "Modele 1 Niv 1 BIS": "level_1_standard",
            "Modele 1 Niv 2 BIS": "level_2_standard",
            "Département de Livraison": "department",
            "Annee": "year",
            "Mois": "month",
            "Ca Brut": "turnover",
            "Poids Brut Facturé": "volume",
            "Nom Segmentation": "segment_1",
            "Code Segment Cible": "segment_2",
        },
        add_columns={"volume_unit": "unknown"},
        turnover_type="brut",
    ),
}

# End of FIXED VALUES
# ---------------------------------------------------------------------------


def required_defaults(*column_lists: list[str], value: str = NOT_FILLED) -> dict[str, str]:
    """{column: default} for the given canonical column lists."""
    out: dict[str, str] = {}
    for cols in column_lists:
        for c in cols:
            out.setdefault(c, value)
    return out


def feeds_without_id(feeds) -> list[str]:
    return [f.name for f in feeds if not f.with_product_id]


def feeds_with_id(feeds) -> list[str]:
    return [f.name for f in feeds if f.with_product_id]


def feeds_with_zip(feeds) -> list[str]:
    return [f.name for f in feeds if f.department_from_zip]
