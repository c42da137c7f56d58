"""Schemas of the domain's tables."""

STANDALONE = (
    "record_key string, filepath string, course_code string, section string, course_name string, course_description string, credit_units double, course_area string, "
    "enrolment_requirements string, acad_term_id string, acad_year_start int, acad_year_end int, term string, start_dt string, end_dt string, grading_basis string, "
    "course_outline_url string, acad_term_boss_id int, class_boss_id int, term_text string, period_text string, total int, current_enrolled int, reserved int, available int, "
    "date_extracted string, bidding_window string"
)
MULTIPLE = (
    "record_key string, type string, start_date string, end_date string, date string, day_of_week string, start_time string, end_time string, venue string, professor_name string"
)
RESULTS = (
    "term string, bidding_window string, course_code string, section string, vacancy string, opening_vacancy string, before_process_vacancy string, d_i_c_e string, "
    "after_process_vacancy string, enrolled_students string, median_bid string, min_bid string, instructor string"
)
TERMS = "id string, acad_year_start int, acad_year_end int, term string, boss_id int, start_dt string, end_dt string"
COURSES = "id string, code string, name string, description string, credit_units double, belong_to_university int, belong_to_faculty int, course_area string, enrolment_requirements string"
FACULTIES = "id int, acronym string"
PROFESSORS = "id string, name string, slug string, boss_aliases array<string>, original_scraped_name string"
BID_WINDOWS = "id int, acad_term_id string, round string, window int"
CLASSES = (
    "id string, section string, course_id string, professor_id string, acad_term_id string, grading_basis string, course_outline_url string, boss_id int, warn_inaccuracy boolean"
)
TIMINGS = "class_id string, start_date string, end_date string, day_of_week string, start_time string, end_time string, venue string"
EXAMS = "class_id string, date string, day_of_week string, start_time string, end_time string, venue string"
AVAILABILITY = "class_id string, bid_window_id int, total int, current_enrolled int, reserved int, available int"
BID_RESULTS = (
    "bid_window_id int, class_id string, vacancy int, opening_vacancy int, before_process_vacancy int, d_i_c_e int, after_process_vacancy int, enrolled_students int, median double, min double"
)
PREDICTIONS = (
    "class_id string, bid_window_id int, model_version string, clf_has_bids_prob double, clf_confidence_score double, median_predicted double, median_uncertainty double, "
    "min_predicted double, min_uncertainty double"
)
SAFETY_FACTORS = "acad_term_id string, prediction_type string, beats_percentage int, multiplier double, multiplier_type string"
