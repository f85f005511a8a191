"""Schemas of remote payloads and local tables."""

PROFILE = (
    "username string, name string, email string, first_name string, last_name string, institutional_affiliation string, orcid string, "
    "academic_interests array<struct<id:int,text:string>>, groups array<struct<id:string,group_name:string,role:string,url:string>>, "
    "avatar string, url string, is_superadmin boolean"
)
REQUIRED_PROFILE_KEYS = ("first_name", "last_name", "institutional_affiliation", "orcid")
TOKEN = (
    "userinfo struct<sub:string,email:string,name:string,idp_name:string,orcid:string>, final_redirect string, kc_username string, "
    "primary_email string, other_emails array<string>, nonce string, iat double, exp double"
)
USERS = "user_id long, username string, email string, active boolean, preferences map<string,string>, user_profile map<string,string>"
IDENTITIES = "method string, id string, user_id long"
ROLES = "id string, name string, description string"
USER_ROLES = "user_id long, role string"
