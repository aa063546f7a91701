"""Fixed-width record layouts of the twelve monthly claim extracts.

Fields follow each other without gaps, so only widths are stated and start
positions are running sums. Kind ``d`` is a yyyy-MM-dd date, ``n`` a number
that may be blank; everything else is trimmed text.
"""

from __future__ import annotations

from dataclasses import dataclass

# Table name, field names, widths and kinds of each extract.
_LAYOUT_TEXT = """
load_adjustments = trc_hfs_adjustments: DCN 15, ServiceLineNbr 2, RecipientID 9, AdjudicatedDt 10 d,
  CorrectedNetLiabilityAmt 11 n, DeltaNetLiabilityAmt 11 n, VoidInd 1

load_main_claims = trc_hfs_main_claims: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9,
  AdjudicatedDt 10 d, ServiceFromDt 10 d, ServiceThruDt 10 d, CatgofServiceCd 3, RecordIDCd 1, ProviderID 12,
  ProviderTypeCd 3, DataTypeCd 1, DocumentCd 2, PayeeID 16, PriorApprovalCd 1, ProviderNPI 10,
  EncounterPriceAmt 11 n, NetLiabilityAmt 11 n, MedicareBillProviderTaxonomy 10, ProviderTaxonomy 10,
  ProviderChargeAmt 11 n, CopayAmt 11 n

load_immunization = trc_hfs_cornerstone_immunization: RecipientID 9, ImmnDt 10 d, ImmnTyp 4, ImunzTypDesc 40

load_lead = trc_hfs_lead: RecipientID 9, LabNumber 16, CollectedDate 10 d, BirthDate 10 d, TestResult 3,
  TestType 1, ConfirmLevel 3, ConfirmDate 10 d

load_pharmacy = trc_hfs_pharmacy: DCN 15, ServiceLineNbr 2, RecipientID 9, AdjudicatedDt 10 d,
  ServiceFromDt 10 d, CatgofServiceCd 3, RecordIDCd 1, ProviderID 12, ProviderTypeCd 3, DataTypeCd 1,
  DocumentCd 2, PayeeID 16, PriorApprovalCd 1, NationalDrugCd 11, DrugDaysSupplyNbr 3 n, DrugQuanAllow 10 n,
  DrugSpecificTherapeuticClassCd 3, PrimaryCareProviderID 12, ProviderNPI 10, PrescribingPractitionerId 12,
  PrescriptionNbr 12, CompoundCd 1, RefillNbr 2, NbrRefillsAuth 2 n, DrugDAWCd 1, PrescriptionDt 10 d,
  PrescribingLastName 15, LabelName 30, GenericCdNbr 5, DrugStrengthDesc 10, GenericInd 1, GenericSequenceNbr 6,
  EncounterPriceAmt 11 n, NetLiabilityAmt 11 n, CopayAmt 11 n

load_recipient_flags = trc_hfs_recipient_flags: RecipientID 9, RecipientFlagCd 2

load_diagnosis = trc_hfs_diagnosis: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9,
  AdjudicatedDt 10 d, DiagCd 8, PrimaryDiagInd 1, TraumaInd 1, DiagPrefixCd 1, POAClaimCd 1, ICDVersion 2

load_institutional = trc_hfs_institutional: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9,
  AdjudicatedDt 10 d, BillTypeFrequencyCd 1, AdmissionSourceCd 2, AdmissionTypeCd 1, DRGGroupCd 3, PricingCd 1,
  AdmissionDt 10 d, DischargeDt 10 d, PatientStatusCd 2, ProviderDRGAssignedCd 7, UBTypeofBillCd 3,
  OutPatientAPLGrp 2, APLProcGroupCd 5, GrouperVersionNbr 3, SOICd 1, InpatientAdmissions 3 n, CoveredDays 5 n,
  AdmissionDiagCd 8, ICDVersion 2

load_nips = trc_hfs_nips: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9, AdjudicatedDt 10 d,
  PlaceOfServiceCd 2, ReferringPractitionerId 12, OriginatingPlaceCd 3, DestinationPlaceCd 3,
  AllowedUnitsQuan 7 n, TotalUnitsQuan 10 n, SpecialPhysicianNPI 10, SeqLineNbr 2

load_compound_drugs = trc_hfs_compound_drugs_detail: DCN 15, ServiceLineNbr 2, RecipientID 9,
  AdjudicatedDt 10 d, NationalDrugCd 11, CompoundDispUnitCd 1, CompoundDosageFormCd 2, IngrQuan 10 n

load_procedure = trc_hfs_procedure: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9,
  AdjudicatedDt 10 d, ProcCd 8, ProcPrefixCd 1, ProcDt 10 d, PrimaryProcInd 1, ProcModifierCd1 2,
  ProcModifierCd2 2, ProcModifierCd3 2, ProcModifierCd4 2, ICDVersion 2, SeqLineNbr 2

load_revenue_codes = trc_hfs_revenue_codes: DCN 15, ServiceLineNbr 2, RejectionStatusCd 1, RecipientID 9,
  AdjudicatedDt 10 d, RevenueCd 4, RevenueHCPCSCd 8, RevenueHCPCSMod1Cd 2, RevenueHCPCSMod2Cd 2,
  RevenueHCPCSMod3Cd 2, RevenueHCPCSMod4Cd 2, NDCNumber1 11, NDCQuantity1 11 n, NDCNumber2 11,
  NDCQuantity2 11 n, NDCNumber3 11, NDCQuantity3 11 n, RevenueNonCoveredChargeAmt 11 n,
  RevenueTotalChargeAmt 11 n, SeqLineNbr 3, EAPGCd 5, EAPGTypeCd 2, EAPGCatgCd 2
"""


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    width: int
    kind: str  # 's' text, 'd' date, 'n' number


@dataclass(frozen=True)
class Layout:
    key: str
    table: str
    fields: tuple[Field, ...]

    @property
    def width(self) -> int:
        return self.fields[-1].start + self.fields[-1].width - 1


def _read_layouts(text: str) -> dict[str, Layout]:
    layouts = {}
    for block in text.strip().split("\n\n"):
        head, body = block.split(":", 1)
        key, table = (part.strip() for part in head.split("="))
        fields, start = [], 1
        for item in body.split(","):
            name, width, *kind = item.split()
            fields.append(Field(name, start, int(width), kind[0] if kind else "s"))
            start += int(width)
        layouts[key] = Layout(key, table, tuple(fields))
    return layouts


LAYOUTS: dict[str, Layout] = _read_layouts(_LAYOUT_TEXT)
