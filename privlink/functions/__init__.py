"""Scalar building blocks, all native Spark expressions."""

from .crypto import fernet_decrypt, fernet_encrypt, fernet_mac_ok, hmac_sha256, new_key, row_iv
from .dates import clinical_day, message_day
from .hashing import pseudonym
from .keys import file_name_from_path, person_file_key

__all__ = [
    "clinical_day",
    "fernet_decrypt",
    "fernet_encrypt",
    "fernet_mac_ok",
    "file_name_from_path",
    "hmac_sha256",
    "message_day",
    "new_key",
    "person_file_key",
    "pseudonym",
    "row_iv",
]
