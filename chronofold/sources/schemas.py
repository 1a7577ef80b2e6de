"""Row types of the sources, as DDL."""

MASTER = "file string, file_date string, change_flag string, code string, name string, unit string, price_kind string, price double, change_date string, abolish_date string, beppyo string, kubun_no string, basic_name string"
MANIFEST = "doc_id string, title string, url string, kind string, notice_date string, effective_date string, fiscal_section string"
RECORD = (
    "doc_id string, page int, setting string, action string, kubun string, effective_date string, approval_no string, sales_name string, product_name string, "
    "product_code string, annex string, applicant string, category string, category_no string, price_text string, price double, price_unit string, heading string, "
    "side string, ref_notice_date string, ocr int, approval_ocr string, approval_fix string, code_ocr string, code_fix string, sales_name_ocr string, applicant_ocr string"
)
PARSED = f"version int, scanned boolean, ocr boolean, ocr_version int, records array<struct<{RECORD.replace(' ', ':').replace(',:', ',')}>>, warnings array<string>, headings array<string>, stats map<string,bigint>, seconds double, error string"
FOREIGN_EVENT = "code string, event_type string, event_date string, date_precision string, changed_fields string, master string"
CHANGED_FIELDS = "array<struct<field:string,old:string,new:string>>"
