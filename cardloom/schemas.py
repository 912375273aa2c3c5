"""Fixed schemas of the model, as DDL: nine tables, the raw files, the document."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "mcc": "code_mcc int, libelle_mcc string",
    "utilisateur_si": (
        "id_utilisateur int, login string, nom_complet string, role string, email string, "
        "actif string, date_creation timestamp, date_derniere_connexion timestamp"
    ),
    "client": (
        "id_client bigint, current_age int, retirement_age int, birth_year int, birth_month int, "
        "gender string, address string, latitude decimal(8,5), longitude decimal(9,5), "
        "per_capita_income string, yearly_income string, total_debt string, credit_score int, "
        "num_credit_cards int, date_creation timestamp, date_modification timestamp"
    ),
    "marchand": (
        "id_marchand bigint, code_mcc int, merchant_city string, merchant_state string, zip string, "
        "date_creation timestamp"
    ),
    "carte": (
        "id_carte bigint, id_client bigint, card_brand string, card_type string, card_number_enc string, "
        "expires string, cvv_enc string, has_chip string, num_cards_issued int, "
        "credit_limit decimal(12,2), acct_open_date date, year_pin_last_changed int, "
        "card_on_dark_web string, date_creation timestamp, date_modification timestamp"
    ),
    "transaction": (
        "id_transaction bigint, id_carte bigint, id_marchand bigint, date_transaction timestamp, "
        "amount decimal(12,2), use_chip string, situation_date date, date_creation timestamp"
    ),
    "label_fraude": "id_transaction bigint, is_fraud string, date_creation timestamp",
    "erreur_transaction": (
        "id_erreur bigint, id_transaction bigint, code_erreur string, date_creation timestamp"
    ),
    "journal_audit": (
        "id_audit bigint, id_utilisateur int, table_concernee string, id_ligne_concernee bigint, "
        "operation string, valeur_avant string, valeur_apres string, date_operation timestamp, "
        "adresse_ip string"
    ),
}

# Columns each loader reads from its raw file, all as text.
RAW_COLUMNS: dict[str, list[str]] = {
    "users": [
        "id", "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address",
        "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt",
        "credit_score", "num_credit_cards",
    ],
    "cards": [
        "id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv", "has_chip",
        "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed",
        "card_on_dark_web",
    ],
    "transactions": [
        "id", "date", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
        "merchant_state", "zip", "mcc", "errors",
    ],
}

DOCUMENT = (
    "id_transaction bigint, date_transaction timestamp, amount decimal(12,2), use_chip string, "
    "situation_date date, "
    "carte struct<id_carte: bigint, card_brand: string, card_type: string, has_chip: boolean, "
    "credit_limit: decimal(12,2), card_on_dark_web: boolean>, "
    "client struct<id_client: bigint, current_age: int, gender: string, credit_score: int, "
    "num_credit_cards: int>, "
    "marchand struct<id_marchand: bigint, ville: string, etat: string, zip: string>, "
    "mcc struct<code: int, libelle: string>, "
    "fraude struct<is_fraud: boolean, labelled: boolean>, "
    "_ingested_at timestamp"
)

# Fixed values of the model's contracts.
USE_CHIP_VALUES = ("Swipe Transaction", "Chip Transaction", "Online Transaction")
GENDERS = ("Male", "Female", "Other")
ROLES = ("admin", "etl", "data_scientist", "analyst", "audit")
OPERATIONS = ("INSERT", "UPDATE", "DELETE")
SECRET_COLUMNS = (
    "address", "per_capita_income", "yearly_income", "total_debt", "card_number_enc", "cvv_enc",
)
