"""ledgerloom: reusable Spark DataFrame operators for CRM, finance, HR and asset-portal analytics."""
