"""Official column names and the source aliases they replace."""

# Official name -> source aliases.
GLOSSARY = {
    # identifiers
    "account_id": ("acct_id", "sf_account_id", "crm_account_id"),
    "user_id": ("uid", "usr_id", "member_id"),
    "organization_id": ("org_id", "company_id"),
    "document_id": ("doc_id",),
    "checklist_id": ("spec_id",),
    "meeting_id": ("call_id", "conversation_id"),
    "deal_id": ("opportunity_id", "opp_id"),
    "contact_id": ("lead_id", "person_id"),
    # financial metrics
    "revenue": ("sales", "gross_sales", "total_sales", "amount"),
    "net_revenue": ("net_sales", "adjusted_revenue"),
    "discount_amount": ("discount", "promo_amount", "coupon_value"),
    "refund_amount": ("refund", "return_amount", "credit_amount"),
    "cost": ("cogs", "cost_of_goods", "unit_cost", "expense"),
    "profit": ("margin", "gross_profit", "net_profit"),
    "mrr": ("monthly_revenue", "subscription_revenue"),
    "arr": ("annual_revenue", "yearly_revenue"),
    "ltv": ("lifetime_value", "clv", "customer_value"),
    # users and contacts
    "contact_name": ("name", "full_name", "client_name", "lead_name"),
    "email": ("email_address", "e_mail", "contact_email"),
    "phone": ("phone_number", "tel", "mobile", "contact_phone"),
    "customer_segment": ("segment", "tier", "classification", "group"),
    "customer_status": ("status", "account_status", "state"),
    "acquisition_channel": ("source", "channel", "referral_source", "utm_source"),
    "industry": ("vertical", "sector", "business_type"),
    "company_size": ("employee_range", "headcount_band", "size"),
    "organization_name": ("org_name", "company_name"),
    "document_type": ("doc_type", "file_type"),
    "checklist_name": ("spec_name",),
    # times
    "created_at": ("create_date", "date_created", "creation_time"),
    "updated_at": ("modified_at", "last_modified", "update_time"),
    "deleted_at": ("removed_at", "archived_at"),
    "inserted_at": ("_loaded_at", "_etl_loaded_at", "load_time"),
    "occurred_at": ("event_time", "action_time", "timestamp"),
    "start_date": ("begin_date", "effective_date"),
    "end_date": ("expiry_date", "termination_date"),
    # flags
    "is_active": ("active", "enabled"),
    "is_deleted": ("deleted", "removed", "archived"),
    "is_test": ("test", "sandbox", "is_sandbox"),
    "has_subscription": ("subscribed", "is_subscriber"),
    "is_churned": ("churned", "lost", "inactive"),
}


def alias_map(glossary: dict[str, tuple[str, ...]] = GLOSSARY) -> dict[str, str]:
    """Alias -> official name."""
    return {alias: name for name, aliases in glossary.items() for alias in aliases}
